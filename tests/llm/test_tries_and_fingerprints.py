"""The conversation trie, the Merkle manifest and the SimHash balls against plain versions."""

import random
from collections import Counter

import brute
import numpy as np
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as driver
from orderloom.llm import conversation_trie, merkle, ordered, simhash

SF_DIR = "/root/testdata/sf0.001"


def given(name):
    return pq.read_table(f"{SF_DIR}/{name}.parquet").to_pylist()


def run(name, spark):
    return Counter(tuple(r) for r in driver.queries()[name](spark, SF_DIR).collect())


def rows_of(table, *columns):
    return [tuple(r[c] for c in columns) for r in given(table)]


# --- conversations -------------------------------------------------------------------------------
def trie(spark, rows, **options):
    # columns that the operator uses inside, and must not trip over
    extra = ", node string, depth string, block string, component string, _pos string, h string"
    df = spark.createDataFrame([(*r, *["x"] * 6) for r in rows], "conv_id long, turn long, role string, text string" + extra)
    return Counter(tuple(r) for r in conversation_trie.prefix_trie(df, **options).collect())


def test_given_conversations(spark):
    assert run("op11_conversation_trie", spark) == brute.prefix_trie(rows_of("conversations", "conv_id", "turn", "role", "text"))


AWKWARD_TURNS = [
    (0, None, None, None), (0, 1, "user", "a"), (0, 1, "user", "a"), (0, 1, "user", "b"), (0, 2, "é", "ß" * 5000),
    (1, 0, "user", ""), (2, 0, None, ""), (3, 5, "us", "era"), (4, 5, "user", "a"), (None, 1, "user", "lost"),
    (11, 0, "user", "no head"), (11, 1, "user", "x"), (12, 0, "user", "no head"), (-3, 0, "user", "a"), (-5, 0, "user", "a"), (-5, 1, "", "a"),
]


@pytest.mark.parametrize("local_nodes", [4096, 3])
def test_awkward_conversations(spark, local_nodes):
    rows = AWKWARD_TURNS + [(100 + k, t, "user", "same") for k in range(30) for t in range(12)]
    rows += [(200 + k, t, "user", f"{t % 2 if t < k else k}") for k in range(25) for t in range(25)]
    assert trie(spark, rows, local_nodes=local_nodes) == brute.prefix_trie(rows)


def test_a_conversation_of_many_blocks(spark, monkeypatch):
    """Prefixes over several levels of blocks, a path that rounds of joins have to split, and copies of it."""
    monkeypatch.setattr(conversation_trie, "BLOCK", 4)
    long = [(0, t, "user", f"t{t % 7}") for t in range(150)]
    rows = long + [(35, t, "user", x if t != 90 else "other") for _, t, _, x in long] + [(40, t, "user", x) for _, t, _, x in long]
    assert trie(spark, rows, local_nodes=16) == brute.prefix_trie(rows)


def test_ends_of_many_conversations_are_hashed_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "IDS_A_CHUNK", 7)
    rows = [(k, 0, "user", "hello") for k in range(500)]
    assert trie(spark, rows) == brute.prefix_trie(rows)


def test_no_conversations(spark):
    assert not trie(spark, []) and not trie(spark, [(None, 1, "user", "x")])


def test_centroids_of_random_trees():
    rng = random.Random(1)
    for n in (1, 2, 3, 50, 400):
        parent = [-1] + [rng.choice((k - 1, rng.randrange(k))) for k in range(1, n)]
        depth = [0] * n
        for k in range(1, n):
            depth[k] = depth[parent[k]] + 1
        values = np.array([[rng.randrange(9), rng.randrange(9)] for _ in range(n)])
        expected = values.copy()
        for k in range(n - 1, 0, -1):
            expected[parent[k]] += expected[k]
        # every node is a conversation of its own
        above = np.array([-1 if p < 0 else p for p in parent])
        sums = conversation_trie.split_locally(np.arange(n), np.array(depth), above, np.zeros(n, np.int64), values)
        assert (sums == expected).all()


# --- manifest ------------------------------------------------------------------------------------
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def proofs(spark, rows):
    extra = ", digest string, kids string, block string, levels string, root string, _row string"
    df = spark.createDataFrame([(*r, *["x"] * 6) for r in rows], "doc_id long, source string, lang string, n_chars long, text string" + extra)
    return Counter(tuple(r) for r in merkle.manifest_proofs(df).collect())


def test_given_documents_are_proved(spark):
    found = run("op12_merkle_manifest", spark)
    assert found == brute.merkle_proofs(rows_of("documents", *FIELDS))
    assert {r[-1] for r in found} == {True, False}


def test_awkward_manifests(spark, monkeypatch):
    odd = [
        (1, None, None, None, None), (None, None, "en", 1, "A"), (None, None, "en", 1, "A"), (2, "", "", 0, ""), (3, "é", "en", 3, "ÀÉ"),
        (3, "é", "en", 3, "ÀÉ"), (4, "z", "en", -5, "Z" * 100_000), (15, "z", "en", 1, "KEEP"), (15, "Z", "en", 1, None),
    ]
    odd += [(k, "hot", "en", k, f"Text {k}") for k in range(300)] + [(k, f"s{k}", None, k, "One") for k in range(40)]
    odd += [(k, f"size {n}", "en", k, f"T{k}") for n in (1, 2, 15, 16, 17, 256, 257) for k in range(n)]
    assert proofs(spark, odd) == brute.merkle_proofs(odd)
    one = [(0, "s", "en", 1, "T")]
    assert proofs(spark, one) == brute.merkle_proofs(one)
    assert not proofs(spark, [])
    monkeypatch.setattr(merkle, "DIGITS", 1)  # as many tiers as there are levels
    assert proofs(spark, odd) == brute.merkle_proofs(odd)


def test_rows_are_numbered_in_order(spark):
    rows = [("a", 1)] * 500 + [("b", k) for k in range(20)] + [(None, 3), (None, 1)]
    placed = ordered.keep_places(spark.createDataFrame(rows, "g string, v long").repartition(5), "placed")
    found = ordered.number_in_order(placed, ["g"], [placed["v"]], "numbered").collect()
    assert Counter((r["g"], r["_size"]) for r in found) == {("a", 500): 500, ("b", 20): 20, (None, 2): 2}
    for g in ("a", "b", None):
        own = sorted((r["_pos"], r["v"]) for r in found if r["g"] == g)
        assert [p for p, _ in own] == list(range(len(own))) and [v for _, v in own] == sorted(v for _, v in own)


# --- fingerprints --------------------------------------------------------------------------------
def near(spark, docs, **options):
    extra = ", bits string, bucket string, flips string, component string, least string"
    df = spark.createDataFrame([(*d, *["x"] * 5) for d in docs], "doc_id long, text string" + extra)
    return Counter(tuple(r) for r in simhash.simhash_duplicates(df, **options).collect())


def test_given_documents_are_linked(spark):
    assert run("op13_simhash", spark) == brute.simhash_duplicates(rows_of("documents", "doc_id", "text"))


def test_awkward_fingerprints(spark):
    base = " ".join(f"w{k}" for k in range(300))
    docs = [(1, None), (2, ""), (3, " \t"), (4, "one"), (5, "ONE"), (6, "one two three"), (7, "a b c d"), (7, "a b c d"), (None, base), (None, "alone here")]
    docs += [(10 + k, base + f" x{k}") for k in range(8)] + [(30, "é ß É " * 50), (31, "z" * 100_000), (32, "q " * 70_000)]
    assert near(spark, docs) == brute.simhash_duplicates(docs)
    assert not near(spark, [])


@pytest.mark.parametrize("bound", [2_000_000, 1500])
def test_balls_find_all_links(spark, monkeypatch, bound):
    """Fingerprints around some centres, close to the radius; with the lower bound, buckets are dealt again and again."""
    monkeypatch.setattr(simhash, "BUCKET_VARIANTS", bound)
    rng, prints = random.Random(2), set()
    for centre in [0, (1 << 64) - 1, *(rng.getrandbits(64) for _ in range(5))]:
        for flips in (0, 1, 2, 4, 4, 5, 5, 8, 9):
            prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), flips)))
    signed = np.array(sorted(prints), dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(b,) for b in signed], "bits long")
    links = [(r["a"] & (1 << 64) - 1, r["b"] & (1 << 64) - 1) for r in simhash.ball_links(df).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in links)
    linked = set(links) | {(b, a) for a, b in links}
    assert brute.reachable(prints, lambda a, b: (a, b) in linked) == brute.reachable(prints, lambda a, b: (a ^ b).bit_count() <= 4)
