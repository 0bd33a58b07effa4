import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm import burst_trie
from tests.llm.data import prose

TURNS = "conv_id long, turn long, role string, text string"


def brute(rows):
    """The definition, in plain Python."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs[c].append(((turn is not None, turn or 0, tie), (role, text)))
    own = {c: tuple(t for _, t in sorted(x)) for c, x in convs.items()}
    rebuilt = {}
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = int(c - (abs(c) % 100) * (1 if c >= 0 else -1))
        rebuilt[c] = own.get(base, ())[:h] + seq[h:]
    return nodes_of(rebuilt)


def nodes_of(rebuilt):
    members = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    out = []
    for p, m in members.items():
        inside = [q for q in members if q[: len(p)] == p]
        ends = ",".join(map(str, sorted(c for c in m if rebuilt[c] == p)))
        out.append((
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), sum(not kids[q] for q in inside),
            sum((len(members[q]) - 1) * len(q[-1][1]) for q in inside if q), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def talk(seed, n, shared=0):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        c = c * 7 if c % 3 else c
        for t in range(rng.randint(0, 6) + shared):
            text = "same" if t < shared else rng.choice(["a", "bb", "ccc", "ñ"])
            rows.append((c, t, rng.choice(["user", "bot"]) if t >= shared else "user", text))
    return rows


@pytest.mark.parametrize("container", [1, 4, 20, 10**6])
def test_equals_brute_force_however_small_the_containers(spark, container):
    rows = talk(1, 60) + talk(2, 30)  # ids of the second repeat turns of the first
    df = spark.createDataFrame(rows, TURNS)
    assert got(burst_trie.trie(burst_trie.shared_openings(burst_trie.sequences(df)), container)) == brute(rows)


def test_long_shared_head_bursts_in_one_round(spark, monkeypatch):
    rows = [(c, t, "user", "same" if t < 40 else f"{c % 5}") for c in range(100, 130) for t in range(42)]
    seqs = burst_trie.sequences(spark.createDataFrame(rows, TURNS))
    items = burst_trie.suffixes(seqs).select(
        F.lit("").alias("cid"), F.lit(0).alias("depth"), F.lit(None).cast("string").alias("parent"),
        "path", "chars", "n", "conv_id", "ends",
    )
    big = burst_trie._overfull(items, 100).collect()
    assert [(r["to"], r["n_convs"], len(r["chars"])) for r in big] == [(40, 30, 41)]
    tree = burst_trie.trie(seqs, 100)
    own = {c: tuple(("user", "same" if t < 40 else f"{c % 5}") for t in range(42)) for c in range(100, 130)}
    assert got(tree) == nodes_of(own)


def test_awkward_rows(spark):
    rows = [
        (5, None, None, None), (5, 1, "user", ""), (5, 1, "user", ""), (5, 1, "bot", "x"), (5, None, "user", "é"),
        (None, 1, "user", "lost"), (7, 0, "user", prose(1, 3000)), (200, 3, None, "q"), (200, 1, "", None), (203, 1, "u", "v"),
        (-250, 1, "u", "v"), (-200, 1, "u", "w"),
    ]
    df = spark.createDataFrame(rows, TURNS).withColumn("path", F.lit(1)).withColumn("n", F.lit("x")).withColumn("seq", F.lit(0))
    for container in (2, 10**6):
        assert got(burst_trie.trie(burst_trie.shared_openings(burst_trie.sequences(df)), container)) == brute(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], TURNS)
    assert burst_trie.trie(burst_trie.shared_openings(burst_trie.sequences(df))).count() == 0


def test_digests_run_across_batches():
    import pyarrow as pa

    batches = [
        pa.record_batch({"key": ["a", "a"], "conv_id": pa.array([1, 2])}),
        pa.record_batch({"key": ["a", "b"], "conv_id": pa.array([3, 9])}),
        pa.record_batch({"key": pa.array([], pa.string()), "conv_id": pa.array([], pa.int64())}),
        pa.record_batch({"key": ["b"], "conv_id": pa.array([10])}),
    ]
    out = {r["key"]: r["ends"] for b in burst_trie._end_digests(iter(batches)) for r in b.to_pylist()}
    assert out == {"a": hashlib.sha256(b"1,2,3").hexdigest(), "b": hashlib.sha256(b"9,10").hexdigest()}
