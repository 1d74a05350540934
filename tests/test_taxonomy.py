import pytest

from readsift.operators import taxonomy as tx
from tests.conftest import plain

REPORT = "sample string, line_no long, level_num int, tax_rank string, taxid int"
ROWS = [
    ("s", 0, 0, "U", 0), ("s", 1, 0, "-", 1), ("s", 2, 1, "-", 20), ("s", 3, 2, "D", 2), ("s", 4, 3, "G", 10),
    ("s", 5, 4, "S", 100), ("s", 6, 5, "S1", 1000), ("s", 7, 6, "-", 1001), ("s", 8, 4, "S", 101),
    ("s", 9, 3, "G", 11), ("s", 10, 4, "-", 110), ("s", 11, 1, "D", 3), ("t", 1, 0, "R", 1), ("t", 2, 1, "G", 10),
]
PARENT = {20: 1, 2: 20, 10: 2, 100: 10, 1000: 100, 1001: 1000, 101: 10, 11: 2, 110: 11, 3: 1}


@pytest.fixture
def report(table):
    return table(REPORT, *ROWS)


def test_edges(report):
    edges = tx.report_edges(report)
    assert {r[0]: r[1] for r in plain(edges.where("sample = 's'"), "taxid", "parent_taxid")} == {**PARENT, 1: None}
    assert plain(edges.where("sample = 't'"), "taxid", "parent_taxid") == [(1, None), (10, 1)]


def test_level_ids(report):
    got = dict(plain(tx.level_ids(report).where("sample = 's'"), "taxid", "level_id"))
    assert got == {1: "R", 20: "R1", 2: "D", 10: "G", 100: "S", 1000: "S1", 1001: "S2", 101: "S", 11: "G",
                   110: "G1", 3: "D"}


def test_closure_against_walking_up(report):
    got = set(plain(tx.taxon_closure(report).where("sample = 's'"), "ancestor", "descendant", "distance"))
    want = set()
    for t in [*PARENT, 1]:
        a, d = t, 0
        while a:
            want.add((a, t, d))
            a, d = PARENT.get(a), d + 1
    assert got == want


def test_ancestors_and_descendants(report, table):
    closure = tx.taxon_closure(report)
    asked = table("sample string, taxid int", ("s", 10), ("s", 777), ("t", 10))
    assert plain(tx.ancestors(closure, asked)) == [
        ("s", 10, 1), ("s", 10, 10), ("s", 10, 2), ("s", 10, 20), ("s", 777, 777), ("t", 10, 1), ("t", 10, 10)]
    assert plain(tx.descendants(closure, asked)) == [
        ("s", 10, 10), ("s", 10, 100), ("s", 10, 1000), ("s", 10, 1001), ("s", 10, 101), ("s", 777, 777),
        ("t", 10, 10)]


@pytest.mark.parametrize("rows", [
    [("s", 1, 0, "R", 1), ("s", 2, 2, "G", 5)],
    [("s", 1, 0, "R", 1), ("s", 2, 0, "G", 5)],
    [("s", 1, 0, "D", 5)],
])
def test_row_without_parent_fails(table, rows):
    with pytest.raises(Exception, match="no parent line"):
        tx.report_edges(table(REPORT, *rows)).collect()
