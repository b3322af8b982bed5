"""The operators against plain Python on small tables with odd rows."""

import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pagelens.llm import bpe, chat, derivatives, fingerprint, jaccard, language, packing, passages, search, tokens

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, n long, node string, range int, text_hash long, part int, guest int, word string, lang string"
ODD = [None, "", " ", "\n\n", "a", "Ünï  ΣΑΣ x\t", "<|endoftext|> <|startoftext|>", "é̀ 中文 \U0001F600", "1234 5678 !!", "\0x\0"]


def table(spark, rows):
    return spark.createDataFrame([(i, t, 7, "x", 1, 2, 3, 4, "w", "en") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    vocabulary = ["".join(r.choices("abcdefgh", k=r.randint(1, 6))) for _ in range(400)]
    texts = [" ".join(r.choices(vocabulary, k=r.randint(1, 120))) + "." for _ in range(40)]
    base = r.choices(vocabulary, k=200)
    for i in range(25):  # A group of near copies, some of which link only over others.
        copy = list(base)
        for place in r.sample(range(200), r.randint(0, 6)):
            copy[place] = f"new{i}x{place}"
        texts.append(" ".join(copy))
    texts += [" ".join(base)] * 8 + ODD + ["y" * 30000 + " " + "z q " * 9000]
    rows = list(enumerate(texts)) + [(3, texts[3]), (3, "other text with the same id here"), (None, "no id at all in this row")]
    return rows


def test_token_files(spark, rows, tmp_path):
    folder = str(tmp_path / "t")
    tokens.write_tokens(table(spark, rows), folder, WORDS, partitions=3)
    library = Tokenizer.from_file(WORDS)
    found = tokens.checksums(tokens.read_tokens(spark, folder)).collect()
    expected = collections.Counter()
    for i, t in rows:
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        expected[i, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == expected
    at = 0
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ordered = [r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert ordered == sorted(ordered, key=lambda i: -1 if i is None else i)
    some = tokens.read_tokens(spark, folder, doc_ids=[5, 9]).collect()
    assert sorted(r.doc_id for r in some) == [5, 9] and all(len(r.tokens) == r.n_tokens for r in some)
    assert "tokens" not in tokens.read_tokens(spark, folder, tokens=False).columns
    import glob
    import pyarrow.parquet as pq
    column = pq.ParquetFile(glob.glob(folder + "/*.parquet")[0]).metadata.row_group(0)
    names = {column.column(i).path_in_schema: column.column(i) for i in range(column.num_columns)}
    assert "DELTA_BINARY_PACKED" in names["n_tokens"].encodings and names["doc_id"].has_column_index
    assert "RLE_DICTIONARY" in str([c.encodings for n, c in names.items() if n.startswith("tokens")])


def test_bpe_round_trip(spark, rows):
    library = Tokenizer.from_file(BYTES)
    found = bpe.round_trip(table(spark, rows), BYTES).collect()
    expected = collections.Counter()
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                 hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert collections.Counter(tuple(r) for r in found) == expected
    back = bpe.decode(bpe.encode(table(spark, rows), BYTES), BYTES).collect()
    assert collections.Counter((r.doc_id, r.text) for r in back) == collections.Counter((i, t or "") for i, t in rows)


def test_packing(spark, rows):
    library = Tokenizer.from_file(WORDS)
    found = packing.pack(table(spark, rows).coalesce(2), WORDS, ahead=2, step_tokens=4096, with_tokens=True).collect()
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in found:
        assert zlib.crc32(np.array(r.tokens, "<u4").tobytes()) == r.ids_crc32 and len(r.tokens) == r.length
        pieces[r.doc_id, r.doc_tokens].append(r)
        sequences[r.sequence_id].append(r)
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        whole = sorted(pieces[i, len(ids)], key=lambda r: r.start)
        assert sum(r.length for r in whole) % len(ids) == 0
        for r in whole:
            if rows.count((i, t)) == 1 and [j for j, _ in rows].count(i) == 1:
                assert r.tokens == ids[r.start:r.start + r.length]
    for parts in sequences.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == list(np.cumsum([0] + [r.length for r in parts])[:-1])
        size = sum(r.length for r in parts)
        assert size <= 2048 and size & (size - 1) == 0  # Full windows of powers of two: nothing is padded.
    steps = collections.Counter()
    for r in found:
        steps[r.step_id] += r.length
    assert max(steps.values()) <= 2 * 4096


def shingles(text):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_jaccard_groups(spark, rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    smallest = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            smallest[find(a)] = min(i, smallest.get(find(a), i))
    expected = collections.Counter((i, len(sets[a]), smallest.get(find(a))) for a, (i, _) in enumerate(rows))
    found = jaccard.similar_groups(table(spark, rows)).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == expected


def test_jaccard_repeated_ids(spark):
    """Texts with one id, or without any, never lend each other the lengths and places of their shingles."""
    counts = spark.sparkContext.broadcast(np.zeros(jaccard.SLOTS, "int64"))
    for key in (7, None):
        rows = [(key, " ".join(f"w{i}" for i in range(k, k + 6 + k % 40))) for k in range(0, 90, 3)]
        texts = jaccard.documents(table(spark, rows).coalesce(2))
        own = {(r.gram, bytes(r.node)): (r.n, r.pos) for r in jaccard.prefixes(texts, 5, 80, counts).collect()}
        shared = jaccard.shared_prefixes(texts, 5, 80, counts).collect()
        assert shared and all(own[r.gram, bytes(r.node)] == (r.n, r.pos) for r in shared)


def test_jaccard_links(spark, rows, monkeypatch):
    """Every pair of different sets once, and all links of each row, in cells of any size."""
    sets = [shingles(t) for _, t in rows]
    similar = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    number = collections.Counter(x for pair in similar for x in pair)
    expected = collections.Counter((i, len(sets[a]), number[a]) for a, (i, _) in enumerate(rows))
    pairs = collections.Counter(tuple(sorted((len(sets[a]), len(sets[b])))) + (len(sets[a] & sets[b]),)
                                for a, b in {tuple(sorted((sets.index(sets[a]), sets.index(sets[b])))) for a, b in similar} if a != b)
    found = jaccard.similar_groups(table(spark, rows), links=True).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.n_links) for r in found) == expected
    monkeypatch.setattr(jaccard, "CELL", 700)
    listed = jaccard.similar_pairs(table(spark, rows)).collect()
    assert len({(bytes(r.a), bytes(r.b)) for r in listed}) == len(listed) and all(r.a < r.b for r in listed)
    assert collections.Counter(tuple(sorted((r.n_a, r.n_b))) + (r.n_common,) for r in listed) == pairs


def test_fingerprints(spark, rows):
    plain = [(i, t) for i, t in rows if i is not None and [j for j, _ in rows].count(i) == 1]
    found = {r.doc_id: r for r in fingerprint.fingerprints(table(spark, plain)).collect()}
    texts = dict(plain)
    order = sorted(texts, reverse=True)
    for i, after in zip(order, order[1:] + order[:1]):
        text, following = texts[i] or "", texts[after] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        assert found[i].n_chars == len(text) and found[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        if edited == text:
            assert found[i].near_edited == 1 and found[i].fingerprint == found[i].edited_fingerprint
        assert (texts[i] == texts[after]) <= (found[i].near_next == 1)
    same = {t: {found[i].fingerprint for i, u in plain if u == t} for _, t in plain}
    assert all(len(prints) == 1 for prints in same.values())

    def similarity(a, b):
        a, b = collections.Counter(a.split()), collections.Counter(b.split())
        return sum((a & b).values()) / sum((a | b).values())
    pairs = [(i, j) for i in range(40, 65) for j in range(40, i)]
    prints = {i: [found[i].fingerprint[k:k + 4] for k in range(0, 128, 4)] for i in range(40, 65)}
    errors = [np.mean([x == y for x, y in zip(prints[i], prints[j])]) - similarity(texts[i], texts[j]) for i, j in pairs]
    assert abs(np.mean(errors)) < 0.05 and np.std(errors) < 0.12
    assert fingerprint.fingerprints(table(spark, rows)).count() == len(rows)


def test_language_gradients():
    rng = np.random.default_rng(2)
    parameters = {k: v.astype("float64") for k, v in language.new_parameters(3, 2, rng).items()}
    x, y = rng.integers(97, 101, (4, 5)).astype("uint8"), np.array([0, 1, 1, 0])

    def loss():
        p = language.probabilities(parameters, x)
        return -np.log(p[:, np.arange(4), y]).mean()

    found = language.gradients(parameters, x, y)
    for name, place in (("state0", (1, 4)), ("state1", (2, 7)), ("input0", (98, 3)), ("input1", (99, 8)), ("output", (2, 1)), ("bias", (0,))):
        before = parameters[name][place]
        parameters[name][place] = before + 1e-3
        up = loss()
        parameters[name][place] = before - 1e-3
        down = loss()
        parameters[name][place] = before
        assert abs((up - down) / 2e-3 - found[name][place]) < 1e-5, name


def test_language(spark, rows):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = language.train(docs.filter("doc_id % 5 <> 0"), steps=400)
    held = docs.filter("doc_id % 5 = 0")
    found = {r.doc_id: r for r in language.predict(held, model).collect()}
    truth = {r.doc_id: r.lang for r in held.collect()}
    assert np.mean([found[i].lang_pred == lang for i, lang in truth.items()]) > 0.97
    assert all(sum(r.labels) == r.n_positions for r in found.values())
    odd = language.predict(table(spark, rows), model).collect()
    assert len(odd) == len(rows) and all(0 <= r.score <= 1 for r in odd)
    und = {i for i, t in rows if i is not None and not any(c.isalpha() for c in t or "")}
    assert {r.doc_id for r in odd if r.lang_pred == "und"} == und
    nothing = language.predict(docs, language.train(docs.limit(0)))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}


def test_search(spark):
    rng = np.random.default_rng(3)
    vectors = rng.integers(-3, 4, (700, 8))
    vectors[100:400] = vectors[5]  # A very common vector: ties go to the smaller id.
    data = [(i, [float(x) / 4 for x in v]) for i, v in enumerate(vectors)]
    data += [(900, None), (901, [None] * 8), (902, [float("nan")] * 8), (903, [float("inf")] * 8), (20, [0.5] * 8)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    found = collections.defaultdict(list)
    integer = search.integer_vectors(frame, scale=4)
    for r in search.top_k(integer, integer.filter("vec_id % 60 = 0"), k=7, block_rows=150).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    rows = [(i, v) for i, v in enumerate(vectors)] + [(20, np.full(8, 2))]
    for q in range(0, 700, 60):
        best = sorted(((-int(v @ vectors[q]), i) for i, v in rows if i != q))[:7]
        assert found[q] == [(i, -s) for s, i in best]
    assert search.top_k(integer.limit(0), integer).count() == 0


def best_of(vectors, queries, k):
    """(query, rank, id, score) by brute force; both are lists of (id, list of integers)."""
    found = collections.Counter()
    for q, x in queries:
        scores = sorted((-sum(a * b for a, b in zip(x, v)), i) for i, v in vectors if i is not None and i != q)[:k]
        found.update((q, rank, i, -s) for rank, (s, i) in enumerate(scores, 1) if q is not None)
    return found


@pytest.mark.parametrize("block_rows", [3, 1000])
def test_search_with_odd_rows(spark, block_rows):
    big = 9007199254740993
    data = [(1, [1, 2]), (1, [3, -4]), (2, []), (3, [5]), (None, [9, 9]), (big, [1, 1, 1]), (big - 1, [1, 1, 1]), (-(2 ** 63), [2, 2]), (4, [0, 0, 0]),
            (4, [0, 0, 0]), (5, [2 ** 25, -2 ** 25]), (6, [2 ** 26 - 1] * 3)]
    frame = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in data], "vec_id long, vector array<long>, q string, d int, stripe int")
    found = search.top_k(frame, frame, k=4, block_rows=block_rows).collect()
    assert collections.Counter((r.query_id, r.rank, r.vec_id, r.score) for r in found) == best_of(data, data, 4)


def test_vectors_that_take_no_part(spark):
    data = [(1, [0.5]), (2, None), (3, [None]), (4, [float("nan")]), (5, [float("-inf")]), (6, [2.0 ** 20]), (7, []), (None, [1.0])]
    found = search.integer_vectors(spark.createDataFrame(data, "vec_id long, embedding array<double>"))
    assert sorted((r.vec_id or 0, list(r.vector)) for r in found.collect()) == [(0, [64]), (1, [32]), (7, [])]


@pytest.mark.parametrize("clusters, most", [(4, 0.5), (10, 0.3), (40, 0.1)])
def test_search_cuts_pairs_of_nodes(clusters, most):
    rng = np.random.default_rng(clusters)
    centers = rng.normal(0, 60, (clusters, 64))
    points = np.floor(centers[rng.integers(0, clusters, 3000)] + rng.normal(0, 3, (3000, 64))).astype("int64")
    ids = rng.permutation(3000)
    found = search.Search(points[:200], ids[:200], 20)
    for at in range(0, 3000, 1000):
        found.meet(points[at:at + 1000], ids[at:at + 1000])
    assert found.compared < most * found.pairs
    scores = points[:200] @ points.T
    scores[ids[:200][:, None] == ids] = search.ABSENT
    order = np.lexsort((np.broadcast_to(ids, scores.shape), ~scores), axis=1)[:, :20]
    assert (found.ids == ids[order]).all() and (found.scores == np.take_along_axis(scores, order, axis=1)).all()


def test_chat(spark):
    r = random.Random(4)
    rows = []
    for conv in range(12):
        for turn in range(r.randint(1, 40)):
            role = "system" if turn == 0 and conv % 2 else ["user", "assistant"][turn % 2]
            text = " ".join(r.choices(["hello", "<|im_end|>", "<\\|x", "<|im_start|>assistant ok", "<\\\\|", "word\n"], k=r.randint(0, 60)))
            rows.append((conv, turn, role, text, 1))
    rows += [(50, 0, "user", None, 1), (50, 0, None, "same turn", 1), (50, 0, None, "same turn", 1), (51, 0, "a\n%<|", "x " * 3000, 1), (None, None, "assistant", "t", 1)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, window int")
    windows = chat.format_conversations(frame, BYTES, budget=200, history=60).cache()
    found = {d.conv_id: d for d in chat.digests(windows).collect()}
    for conv in {row[0] for row in rows}:
        turns = sorted([(-1 if t is None else t, role or "", text or "") for c, t, role, text, _ in rows if c == conv])
        whole = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        d = found[conv]
        assert (d.n_turns, d.turns_sha256) == (len(turns), hashlib.sha256(whole.encode()).hexdigest())
        assert (d.loss_chars, d.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for w in windows.collect():
        assert w.tokens <= 200 or len(w.turns) - w.n_repeated == 1
        assert w.text.count("<|im_start|>") == len(w.turns) == w.text.count("<|im_end|>")
        if w.window and w.conv_id is not None and w.conv_id % 2 and w.tokens <= 200:
            first = w.turns[0]
            assert w.text[first["role_start"]:first["role_stop"]] == "system"


def test_derivatives(spark):
    page = "<html><head><title>T</title><script>x<p></script></head><body><p>One &amp; two</p><!-- c --><div>Three"
    data = [("<urn:a>", "http://h/", "2024-01-01T00:00:00Z", f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n{page}".encode(), 1),
            ("<urn:b>", None, None, None, 1), (None, "http://x/", "d", b"", 1), ("<urn:c>", "u", "d", ("h\r\n\r\n" + "<script>" * 20000).encode(), 1)]
    frame = spark.createDataFrame(data, "warc_id string, url string, warc_date string, payload binary, _body int")
    found = {r.warc_id: r for r in derivatives.derive(frame).collect()}
    assert found["<urn:a>"].conversion_text == "T\nOne & two\nThree" and found["<urn:c>"].conversion_text == ""
    for r in found.values():
        for record, own in ((r.conversion_record, r.conversion_id), (r.metadata_record, r.metadata_id)):
            head, block = record.split("\r\n\r\n", 1)
            headers = dict(line.split(": ", 1) for line in head.split("\r\n")[1:])
            assert headers["WARC-Record-ID"] == own and headers.get("WARC-Refers-To") == r.warc_id
            block = block[:-4].encode()
            assert int(headers["Content-Length"]) == len(block)
            assert headers["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(block).hexdigest()
    assert "source-status: 200\r\n" in found["<urn:a>"].metadata_record
    assert f"conversion-record: {found['<urn:a>'].conversion_id}" in found["<urn:a>"].metadata_record


def test_passages(spark, rows):
    import re
    more = rows + [(200, "Start here. A passage of more than five words. Rest."), (201, "Other words.  a PASSAGE of more than five words! Tail of it."), (202, "x. " * 50)]
    seen, expected = set(), {}
    order = {i: t for i, t in more if [j for j, _ in more].count(i) == 1}
    plain = [(i, t) for i, t in more if i in order and i is not None]
    for i, t in sorted(plain):
        rest, gone = "", 0
        for unit in re.findall(passages.UNIT, t or ""):
            words = re.sub(passages.BLANKS, " ", unit.lower()).strip(" ")
            if words.count(" ") >= 4 and words in seen:
                gone += 1
            else:
                rest += unit
                seen.add(words)
        expected[i] = (t if t is None else rest, gone)
    found = {r.doc_id: r for r in passages.drop_repeats(table(spark, plain)).collect()}
    assert {i: (r.text, r.n_removed) for i, r in found.items()} == expected
    texts = dict(plain)
    for i, r in found.items():
        if texts[i]:
            assert "".join(texts[i][s["start"]:s["stop"]] for s in r.kept) == r.text
            assert sum(s["stop"] - s["start"] for s in r.kept + r.removed) == len(texts[i])
    assert passages.drop_repeats(table(spark, more)).count() == len(more)


def test_empty_tables(spark, tmp_path):
    none = table(spark, [(1, "a")]).limit(0)
    assert bpe.round_trip(none, BYTES).count() == packing.pack(none, WORDS).count() == passages.drop_repeats(none).count() == 0
    assert fingerprint.fingerprints(none).count() == jaccard.similar_groups(none).count() == 0
    tokens.write_tokens(none, str(tmp_path / "e"), WORDS)
    assert tokens.read_tokens(spark, str(tmp_path / "e")).count() == 0


def test_jaccard_long_sets_are_told_apart(spark, monkeypatch):
    """Long sets that are far from similar, but share shingles of their prefixes, are not compared whole; similar ones are."""
    words = [f"w{i}" for i in range(6000)]
    other = [f"x{i}" for i in range(6000)]
    a, b = " ".join(words), " ".join(words[:2700] + other[2700:])
    rows = [(1, a), (2, b), (3, a + " and more")]
    pairs, verified = [], jaccard.verified
    monkeypatch.setattr(jaccard, "total_counts", lambda _: np.zeros(jaccard.SLOTS, "int64"))
    monkeypatch.setattr(jaccard, "verified", lambda texts, found, *rest: pairs.append(found.count()) or verified(texts, found, *rest))
    found = jaccard.similar_groups(table(spark, rows)).collect()
    assert {r.doc_id: r.component_id for r in found} == {1: 1, 2: 2, 3: 1}
    assert sum(pairs) == 1


def test_verified_cuts_every_text_once(spark):
    """Both sides of the pairs come from one pass over the texts, also where Spark doesn't reuse the exchange."""
    from pyspark.sql import functions as F
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(words[:39] + [f"x{i}"])) for i in range(6)]
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    texts = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    nodes = jaccard.profile(texts, 5).filter("node IS NOT NULL").select("node").distinct()
    pairs = jaccard.stored(nodes.select(F.col("node").alias("a")).join(nodes.select(F.col("node").alias("b")), F.col("a") < F.col("b")), "test")
    reuse = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        links = jaccard.verified(texts.mapInArrow(counted, texts.schema), pairs, 5, 80)
    finally:
        spark.conf.set("spark.sql.exchange.reuse", reuse)
    assert links.count() == 15 and seen.value == 6
