from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from twinsift.session import local_session  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cpus=4, shuffle_partitions=4, app="twinsift-tests")
    yield s


@pytest.fixture
def sample(spark):
    """The six-row people fixture: a repeat with another id (ID1/ID2), two
    other people (ID3, ID6), a case variant (ID4), a blank-padded variant (ID5)."""
    rows = [
        ("ID1", "Tarik Oduya", "tarik@lindenpost.org", "8 Harbour Row"),
        ("ID2", "Tarik Oduya", "tarik@lindenpost.org", "8 Harbour Row"),
        ("ID3", "Mei Castellan", "mei@lindenpost.org", "41 Quarry Hill"),
        ("ID4", "tarik oduya", "TARIK@LINDENPOST.ORG", "8 Harbour Row"),
        ("ID5", "  Tarik Oduya  ", "tarik@lindenpost.org", "8 Harbour Row"),
        ("ID6", "Pelle Brandvik", "pelle@lindenpost.org", "207 Mill Lane"),
    ]
    return spark.createDataFrame(rows, "id string, name string, email string, address string")


def ids(df, col="id"):
    return sorted(r[0] for r in df.select(col).collect())
