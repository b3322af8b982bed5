"""The prefix trie against plain Python, on one and on many shards."""

import collections
import hashlib
import random
import zlib

import pytest

from pagelens.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, path string, steps int, base long, h int, chars int, shard int, key string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "p", 1, 2, 3, 4, 5, "k") for r in rows], SCHEMA).repartition(3)


def digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def sequences(rows):
    convs = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            convs[conv].append((turn is not None, turn or 0, digest(role, text), role, text))
    return {c: [(role, text) for *_, role, text in sorted(turns)] for c, turns in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - (abs(c) % 100) * (1 if c >= 0 else -1), [])[:h] + own[h:]
    return out


def expected(convs):
    members, children = collections.defaultdict(list), collections.defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[:d - 1])].add(tuple(turns[:d]))
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[b] for b in below) if below else 1
        saved[node] = sum(saved[b] for b in below) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    out = collections.Counter()
    for node, convs_here in members.items():
        ends = ",".join(str(c) for c in sorted(convs_here) if len(convs[c]) == len(node))
        out[min(convs_here), len(node), min(members[node[:-1]]) if node else None, len(convs_here), len(children[node]), leaves[node], saved[node],
            hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


def found(df):
    return collections.Counter(tuple(r) for r in df.select(*trie.RESULT).collect())


def compare(spark, rows, shards, width=trie.WIDTH):
    convs = trie.conversations(table(spark, rows))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(shards))
    try:
        plain = sequences(rows)
        assert found(trie.prefix_trie(convs, width=width)) == expected(plain)
        assert found(trie.prefix_trie(trie.with_shared_beginnings(convs), width=width)) == expected(rebuilt(plain))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def random_rows(seed, n=60):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        c = r.choice([c, c + 100, -c, 100 * c])
        for t in range(r.choice([1, 2, 3, 8])):
            rows.append((c, t, r.choice(["user", "assistant"]), r.choice(["a", "hello", "long text " * 5, ""])))
    return rows


@pytest.mark.parametrize("shards, width", [(1, 64), (7, 64), (40, 2)])
def test_random_conversations(spark, shards, width):
    compare(spark, random_rows(shards), shards, width)


@pytest.mark.parametrize("shards, width", [(1, 3), (9, 4)])
def test_copies_long_and_odd_conversations(spark, shards, width):
    rows = [(c, t, "user", f"t{t}") for c in range(1000, 1060) for t in range(3)]  # One sequence over several shards.
    rows += [(c, t, "user", f"t{t}") for c in (2001, 2002) for t in range(50)]  # Long ones that share everything,
    rows += [(2003, t, "user", f"t{t}" if t < 31 else f"u{t}") for t in range(90)]  # a part,
    rows += [(2004, t, "user", f"v{t}") for t in range(200)]  # or nothing.
    rows += [(5, None, None, None), (5, None, "user", "x"), (5, 1, "user", "x"), (5, 1, "user", "x"), (5, 1, "assistant", None), (5, -3, "", "é中\U0001F600")]
    rows += [(None, 1, "user", "no conversation"), (None, None, None, None), (-101, 0, "user", "t0"), (-100, 0, "user", "t0"), (-100, 1, "user", "t1")]
    compare(spark, rows, shards, width)


def test_roles_and_texts_are_kept_apart(spark):
    compare(spark, [(1, 0, "ab", "c"), (2, 0, "a", "bc"), (3, 0, "", "abc"), (4, 0, None, "abc"), (6, 0, "1:a", "b"), (7, 0, "a", "1:b")], 2)


def test_long_list_of_ends_over_shards(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 3)
    compare(spark, [(c, 0, "user", "same") for c in range(100, 160)], 8)


def test_conversations_without_turns_after_rebuilding(spark):
    rows = [(c, 0, "user", f"only {c}") for c in range(101, 160)]  # Nothing begins their hundred.
    compare(spark, rows, 4)


def test_empty_table(spark):
    convs = trie.conversations(table(spark, [(1, 0, "user", "a")]).limit(0))
    assert trie.prefix_trie(trie.with_shared_beginnings(convs)).collect() == []
