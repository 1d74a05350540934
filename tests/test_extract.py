import pytest

from readsift.operators import extract as ex
from readsift.operators.taxonomy import taxon_closure
from tests.conftest import plain

ASSIGN = "sample string, line_no long, read_id string, taxid int"
READS = "sample string, mate int, id string, seq string"
REPORT = "sample string, line_no long, level_num int, tax_rank string, taxid int"


@pytest.fixture
def closure(table):
    return taxon_closure(table(
        REPORT, ("s", 1, 0, "R", 1), ("s", 2, 1, "G", 10), ("s", 3, 2, "S", 100), ("s", 4, 1, "G", 11),
        ("t", 1, 0, "R", 1), ("t", 2, 1, "G", 11)))


@pytest.fixture
def assignments(table):
    return table(
        ASSIGN, ("s", 1, "a", 10), ("s", 2, "b", 100), ("s", 3, "c", 11), ("s", 4, "d/1", 100), ("s", 5, "u", 0),
        ("s", 6, "b", 10), ("s", 7, "r", 1), ("t", 1, "a", 100), ("t", 2, "z", 11))


@pytest.fixture
def reads(table):
    ids = ["a", "a/1", "a/2", "b", "b", "c/1", "d/1", "d/2", "d", "x/1abc", "u", "a/1/1", "r"]
    return table(READS, *[("s", 1, i, "A") for i in ids], ("t", 1, "a", "T"), ("t", 2, "z/2", "T"))


def ids(df):
    return [(s, i) for s, i in plain(df, "sample", "id")]


def brute(wanted, read_rows, anywhere=False):
    out = []
    for s, i in read_rows:
        if anywhere:
            short = i[:-2] if "/1" in i or "/2" in i else i
        else:
            short = i[:-2] if i.endswith(("/1", "/2")) else i
        if (s, i) in wanted or (s, short) in wanted:
            out.append((s, i))
    return sorted(out, key=repr)


@pytest.mark.parametrize("anywhere", [False, True])
@pytest.mark.parametrize("listed", [["a"], ["a/1"], ["x/1a"], ["d/1", "d"], ["a", "a/1", "b"], ["a/1/1"], []])
def test_id_rule_against_brute_force(table, reads, listed, anywhere):
    id_rows = table("sample string, read_id string", *[("s", i) for i in listed]) if listed else table(
        "sample string, read_id string").limit(0)
    got = ids(ex.match_reads(reads, id_rows, anywhere=anywhere))
    assert got == brute({("s", i) for i in listed}, [tuple(r) for r in reads.select("sample", "id").collect()], anywhere)


def test_exact_taxa_only(assignments, reads):
    assert ids(ex.extract_reads(assignments, reads, [10])) == brute(
        {("s", "a"), ("s", "b")}, [tuple(r) for r in reads.select("sample", "id").collect()])


def test_children_parents_and_unknown(assignments, closure):
    def taxa(**kw):
        return {(r[0], r[1]) for r in plain(ex.select_assignments(assignments, [10, 777], closure, **kw), "sample", "taxid")}

    assert taxa(children=True) == {("s", 10), ("s", 100)}
    assert taxa(parents=True) == {("s", 10), ("s", 1)}
    assert taxa(children=True, parents=True) == {("s", 10), ("s", 100), ("s", 1)}


def test_exclude_is_the_rest(assignments, closure):
    kept = ex.select_assignments(assignments, [10], closure, children=True)
    rest = ex.select_assignments(assignments, [10], closure, children=True, exclude=True)
    assert plain(kept.unionByName(rest)) == plain(assignments)
    assert ("s", "u") in [(r[0], r[1]) for r in plain(rest, "sample", "read_id")]


def test_expansion_needs_a_closure(assignments):
    with pytest.raises(ValueError):
        ex.select_assignments(assignments, [10], children=True)


@pytest.mark.parametrize("n,want", [(0, []), (1, ["a"]), (3, ["a", "b", "c"]), (99, ["a", "b", "c", "d/1", "r", "u"])])
def test_first_distinct_ids_in_file_order(assignments, n, want):
    got = ex.first_ids(assignments.where("sample = 's'"), n, block=2)
    assert sorted(r[1] for r in plain(got)) == want


def test_all_targets_once_per_target(assignments, reads, closure, table):
    targets = table("sample string, taxid int", ("s", 1), ("s", 10), ("t", 11))
    got = plain(ex.extract_all(assignments, reads, closure, targets), "target", "sample", "id")
    rows = [tuple(r) for r in reads.select("sample", "id").collect()]
    under = {1: {"a", "b", "c", "d/1", "r"}, 10: {"a", "b", "d/1"}}
    want = [(t, *r) for t, names in under.items() for r in brute({("s", n) for n in names}, rows)]
    assert got == sorted([*want, (11, "t", "z/2")], key=repr)


def test_summary(assignments, reads, closure):
    got = plain(ex.extract_summary(assignments, reads, [10], closure, children=True))
    found = ex.extract_reads(assignments, reads, [10], closure, children=True).count()
    assert got == [("s", 2, 7, 3, found), ("t", 1, 2, 0, 0)]


def test_counts_per_taxon(assignments):
    assert plain(ex.taxon_counts(assignments.where("sample = 's'")), "taxid", "n") == [
        (0, 1), (1, 1), (10, 2), (100, 2), (11, 1)]
