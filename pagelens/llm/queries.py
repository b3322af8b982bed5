"""One query per operator: name -> function of (spark, folder), and DuckDB SQL where it can say the same."""

import public_tokenizers
from pyspark.sql import functions as F

from pagelens.functions import html
from pagelens.llm import bpe, chat, derivatives, fingerprint, jaccard, language, lines, packing, passages, search, tokens, trie, whitening
from pagelens.session import shared_folder

QUERIES, ORACLES = {}, {}
WORDS, BYTES = "word_bpe_49k.json", "byte_bpe_50k.json"


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark, folder, name, *columns):
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def documents(spark, folder, *more):
    return table(spark, folder, "documents", "doc_id", "text", *more)


@query
def op1_token_files(spark, folder):
    """Texts to token files and back."""
    files = shared_folder(spark, "tokens-")
    tokens.write_tokens(documents(spark, folder), files, public_tokenizers.path(WORDS), end_id=2)
    return tokens.checksums(tokens.read_tokens(spark, files))


@query
def op2_ngram_jaccard_join(spark, folder):
    """Groups of near copies among the documents."""
    found = jaccard.similar_groups(documents(spark, folder), percent=80, size=5)
    return found.select("doc_id", "n_shingles", "component_id", "copies")


@query
def op3_fingerprints(spark, folder):
    """Fingerprints of the documents and of their edited texts."""
    return fingerprint.fingerprints(documents(spark, folder))


@query
def op2_ngram_jaccard_links(spark, folder):
    """The same groups, with the number of similar documents of each: the whole join."""
    found = jaccard.similar_groups(documents(spark, folder), percent=80, size=5, links=True)
    return found.select("doc_id", "n_shingles", "component_id", "copies", "n_links")


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


@query
def op4_language_id(spark, folder):
    """Languages of the documents, learned from four fifths of them."""
    docs = documents(spark, folder, "lang")
    model = language.train(docs.filter(~held_out()))
    found = language.predict(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "n_positions")


@query
def op5_exact_top_k(spark, folder):
    """The 20 nearest vectors of every twentieth one."""
    vectors = search.integer_vectors(table(spark, folder, "embeddings", "vec_id", "embedding"))
    return search.top_k(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


PROBE = "<|im_end|><|im_start|>assistant ok"


@query
def op6_chat_format(spark, folder):
    """Conversations to training windows and back."""
    turns = table(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    files = shared_folder(spark, "chat-")
    chat.format_conversations(turns.unionByName(probe), public_tokenizers.path(BYTES)).write.parquet(files)
    return chat.digests(spark.read.parquet(files))


@query
def op7_bpe(spark, folder):
    """Texts to byte-level ids and back."""
    return bpe.round_trip(documents(spark, folder), public_tokenizers.path(BYTES))


@query
def op8_packing(spark, folder):
    """Pieces of the documents in windows of at most 2048 ids."""
    return packing.pack(documents(spark, folder), public_tokenizers.path(WORDS), end_id=1)


HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nServer: s"


@query
def op9_warc_derivatives(spark, folder):
    """Metadata and conversion records of the pages, taken as responses."""
    pages = table(spark, folder, "pages", "page_id", "url", "html")
    responses = pages.select(
        F.format_string("<urn:page:%d>", "page_id").alias("warc_id"), "url", F.lit("2024-01-01T00:00:00Z").alias("warc_date"),
        F.concat(F.lit(HTTP_HEAD), (F.col("page_id") % 3).cast("string"), F.lit("\r\n\r\n"), F.coalesce("html", F.lit(""))).cast("binary").alias("payload"))
    derived = derivatives.derive(responses)
    return derived.select(
        F.regexp_extract("warc_id", r"(\d+)>", 1).cast("long").alias("page_id"), F.col("warc_id").alias("refers_to"), "url", "payload_digest",
        "conversion_id", "metadata_id", F.char_length("conversion_text").cast("long").alias("text_chars"),
        F.sha2("conversion_record", 256).alias("conversion_sha256"), F.sha2("metadata_record", 256).alias("metadata_sha256"))


@query
def op10_passage_dedup(spark, folder):
    """Documents without passages that an earlier place already has."""
    found = passages.drop_repeats(documents(spark, folder))

    def spans(name):
        return F.array_join(F.transform(name, lambda s: F.concat_ws("-", s["start"].cast("string"), s["stop"].cast("string"))), ",").alias(name)

    return found.select("doc_id", "text", "n_removed", spans("removed"), spans("kept"))


@query
def op11_line_dedup(spark, folder):
    """Documents without the lines that at least three of them have."""
    found = lines.drop_common_lines(documents(spark, folder), min_documents=3, min_chars=20)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query
def op12_prefix_trie(spark, folder):
    """The trie of the conversations, rebuilt so that those of a hundred share beginnings."""
    turns = table(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    return trie.prefix_trie(trie.with_shared_beginnings(trie.conversations(turns)))


@query
def op13_whitening(spark, folder):
    """The first 32 whitened components of the embeddings."""
    return whitening.whiten(table(spark, folder, "embeddings", "vec_id", "embedding"), most=32)


# ---------------------------------------------------------------------- oracles
ORACLES["op2_ngram_jaccard_join"] = r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
s AS MATERIALIZED (
  SELECT row_id, doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS grams FROM w),
g AS MATERIALIZED (SELECT row_id, len(grams) AS n, unnest(grams) AS gram FROM s),
c AS MATERIALIZED (
  SELECT x.row_id AS a, y.row_id AS b FROM g x JOIN g y ON x.gram = y.gram AND x.row_id < y.row_id
  GROUP BY x.row_id, y.row_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
e AS MATERIALIZED (SELECT a, b FROM c UNION ALL SELECT b, a FROM c),
reach(a, b) AS (SELECT row_id, row_id FROM s UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
copies AS (SELECT grams, count(*) AS copies FROM (SELECT list_sort(grams) AS grams FROM s) GROUP BY grams)
SELECT s.doc_id, CAST(len(s.grams) AS BIGINT) AS n_shingles, min(t.doc_id) AS component_id,
  CASE WHEN len(s.grams) = 0 THEN 1 ELSE any_value(k.copies) END AS copies
FROM s JOIN reach ON s.row_id = reach.a JOIN s t ON t.row_id = reach.b JOIN copies k ON k.grams = list_sort(s.grams)
GROUP BY s.row_id, s.doc_id, s.grams"""

ORACLES["op2_ngram_jaccard_links"] = ORACLES["op2_ngram_jaccard_join"].replace(
    "AS copies\nFROM s JOIN reach", "AS copies, (SELECT count(*) FROM e WHERE e.a = s.row_id) AS n_links\nFROM s JOIN reach")

ORACLES["op5_exact_top_k"] = """
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS vector FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(CAST(q.vector AS DOUBLE[]), CAST(d.vector AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 20"""


def derivative_sql():
    blanks = r"[\x20\x09-\x0D]+"
    text = r"regexp_replace(html, '(?s)<!--.*?(?:-->|\z)', ' ', 'g')"
    for name in derivatives.UNSHOWN:
        text = rf"regexp_replace({text}, '(?is)<{name}\b[^>]*>.*?(?:</{name}\s*>|\z)', ' ', 'g')"
    for pattern, new in ((blanks, "' '"), (rf"(?i)</?(?:{derivatives.BLOCKS})\b[^>]*>", "chr(10)"), ("<[A-Za-z/!?][^>]*>", "''"),
                         (r" *\n[ \n]*", "chr(10)"), (r"\A[ \n]+|[ \n]+\z", "''")):
        text = f"regexp_replace({text}, '{pattern}', {new}, 'g')"
    for name in ("lt", "gt", "quot", "apos", "nbsp", "copy", "middot", "raquo", "laquo", "ndash", "mdash", "lsquo", "rsquo", "amp"):
        text = f"replace({text}, '&{name};', chr({ord(html.ENTITIES[name])}))"

    def record_id(kind):
        digest = f"sha256('{kind}' || chr(10) || warc_id || chr(10) || coalesce(url, '') || chr(10) || payload_digest)"
        return " || ".join(["'<urn:uuid:'", f"{digest}[1:8]", "'-'", f"{digest}[9:12]", "'-5'", f"{digest}[14:16]", "'-8'", f"{digest}[18:20]",
                            "'-'", f"{digest}[21:32]", "'>'"])

    def record(kind, own, content_type, block):
        lines = [("WARC-Type", f"'{kind}'"), ("WARC-Record-ID", own), ("WARC-Refers-To", "warc_id"), ("WARC-Target-URI", "url"),
                 ("WARC-Date", "'2024-01-01T00:00:00Z'"), ("Content-Type", f"'{content_type}'"), ("WARC-Block-Digest", f"'sha256:' || sha256({block})"),
                 ("Content-Length", f"CAST(octet_length(encode({block})) AS VARCHAR)")]
        head = " || ".join(f"coalesce('{n}: ' || {v} || nl, '')" for n, v in lines)
        return f"'WARC/1.0' || nl || {head} || nl || {block} || nl || nl"

    fields = " || ".join(f"'{n}: ' || {v} || nl" for n, v in (
        ("source-status", "'200'"), ("source-content-type", "'text/html; charset=utf-8'"), ("source-server", "'s' || CAST(page_id % 3 AS VARCHAR)"),
        ("source-payload-digest", "payload_digest"), ("conversion-record", "conversion_id"), ("conversion-digest", "'sha256:' || sha256(body)"),
        ("conversion-characters", "CAST(length(body) AS VARCHAR)")))
    return f"""
WITH a AS (SELECT page_id, url, chr(13) || chr(10) AS nl, '<urn:page:' || CAST(page_id AS VARCHAR) || '>' AS warc_id,
  'sha256:' || sha256(coalesce(html, '')) AS payload_digest, coalesce({text}, '') AS body FROM pages),
b AS (SELECT *, {record_id('conversion')} AS conversion_id, {record_id('metadata')} AS metadata_id FROM a),
c AS (SELECT *, {fields} AS fields FROM b)
SELECT page_id, warc_id AS refers_to, url, payload_digest, conversion_id, metadata_id, CAST(length(body) AS BIGINT) AS text_chars,
  sha256({record('conversion', 'conversion_id', 'text/plain; charset=UTF-8', 'body')}) AS conversion_sha256,
  sha256({record('metadata', 'metadata_id', 'application/warc-fields', 'fields')}) AS metadata_sha256 FROM c"""


ORACLES["op9_warc_derivatives"] = derivative_sql()

# Spans as text, neighbouring units merged.
SPANS = """array_to_string(list_transform(list_filter(runs, lambda r: r.gone = {gone}), lambda r: CAST(r.start AS VARCHAR) || '-' || CAST(r.stop AS VARCHAR)), ',')"""
ORACLES["op10_passage_dedup"] = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row_id, doc_id, text, regexp_extract_all(text, '{passages.UNIT}') AS parts FROM documents),
p AS (SELECT row_id, doc_id, unnest(parts) AS part, unnest(range(1, len(parts) + 1)) AS i FROM d),
u AS (SELECT *, length(part) AS size, trim(regexp_replace(lower(part), '{passages.BLANKS}', ' ', 'g')) AS words FROM p),
o AS (SELECT *, sum(size) OVER (PARTITION BY row_id ORDER BY i) - size AS start,
  len(string_split(words, ' ')) >= 5 AND row_number() OVER (PARTITION BY words ORDER BY doc_id, i) > 1 AS gone FROM u),
m AS (SELECT *, sum(CASE WHEN gone IS DISTINCT FROM before THEN 1 ELSE 0 END) OVER (PARTITION BY row_id ORDER BY i) AS run FROM (
  SELECT *, lag(gone) OVER (PARTITION BY row_id ORDER BY i) AS before FROM o)),
r AS (SELECT row_id, run, any_value(gone) AS gone, CAST(min(start) AS BIGINT) AS start, CAST(max(start + size) AS BIGINT) AS stop,
  string_agg(part, '' ORDER BY i) AS piece, count(*) AS n FROM m GROUP BY row_id, run),
f AS (SELECT row_id, list(struct_pack(gone := gone, start := start, stop := stop) ORDER BY start) AS runs,
  coalesce(string_agg(piece, '' ORDER BY start) FILTER (NOT gone), '') AS rest, CAST(coalesce(sum(n) FILTER (gone), 0) AS BIGINT) AS n_removed FROM r GROUP BY row_id)
SELECT d.doc_id, CASE WHEN f.row_id IS NULL THEN d.text ELSE f.rest END AS text, coalesce(n_removed, 0) AS n_removed,
  coalesce({SPANS.format(gone='true')}, '') AS removed, coalesce({SPANS.format(gone='false')}, '') AS kept
FROM d LEFT JOIN f ON d.row_id = f.row_id"""

ORACLES["op11_line_dedup"] = """
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row_id, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
l AS MATERIALIZED (SELECT row_id, doc_id, i, line, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS words
  FROM (SELECT row_id, doc_id, unnest(range(len(parts))) AS i, unnest(parts) AS line FROM d)),
k AS MATERIALIZED (SELECT words, max(doc_id) AS keeper FROM l WHERE length(words) >= 20
  GROUP BY words HAVING count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), '')) >= 3),
m AS (SELECT l.*, k.words IS NOT NULL AND l.doc_id IS DISTINCT FROM k.keeper AS gone FROM l LEFT JOIN k ON l.words = k.words)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY row_id, doc_id"""

CRC_TABLE = "list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END, b))"
ORACLES["op12_prefix_trie"] = f"""
WITH k AS MATERIALIZED (SELECT {CRC_TABLE} AS crc),
t AS MATERIALIZED (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, unhex(md5(step)), length(text)) AS i, md5(step) AS digest, length(text) AS chars FROM (
    SELECT conv_id, turn, coalesce(text, '') AS text, length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS step
    FROM conversations WHERE conv_id IS NOT NULL)),
ids AS MATERIALIZED (
  SELECT c, c - c % 100 AS base, xor(4294967295, list_reduce(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda s, b: xor(s // 256, k.crc[CAST(xor(s % 256, b) AS INTEGER) + 1]), 4294967295)) % 6 AS h
  FROM (SELECT DISTINCT c FROM t), k),
s AS MATERIALIZED (
  SELECT c, digest, chars, row_number() OVER (PARTITION BY c ORDER BY own, i) AS d FROM (
    SELECT ids.c, false AS own, t.i, digest, chars FROM ids JOIN t ON t.c = ids.base AND t.i <= ids.h
    UNION ALL SELECT ids.c, true, t.i, digest, chars FROM ids JOIN t ON t.c = ids.c AND t.i > ids.h)),
p AS MATERIALIZED (
  SELECT c, 0 AS d, '' AS node, 0 AS chars FROM ids
  UNION ALL SELECT c, d, string_agg(digest, '') OVER (PARTITION BY c ORDER BY d), chars FROM s),
z AS (SELECT c, max(d) AS len FROM p GROUP BY c),
n AS MATERIALIZED (
  SELECT node, d, min(p.c) AS conv_id, count(*) AS n, any_value(chars) AS chars,
    sha256(coalesce(string_agg(CAST(p.c AS VARCHAR), ',' ORDER BY p.c) FILTER (z.len = d), '')) AS ends
  FROM p JOIN z ON p.c = z.c GROUP BY node, d),
e AS MATERIALIZED (SELECT n.*, u.node AS parent FROM n LEFT JOIN p u ON u.c = n.conv_id AND u.d = n.d - 1),
kids AS (SELECT parent, count(*) AS kids FROM e WHERE parent IS NOT NULL GROUP BY parent),
f AS MATERIALIZED (SELECT e.*, coalesce(kids, 0) AS kids FROM e LEFT JOIN kids ON kids.parent = e.node),
a AS (SELECT u.node, count(*) FILTER (f.kids = 0) AS leaves, sum((f.n - 1) * f.chars) AS saved FROM f JOIN p u ON u.c = f.conv_id AND u.d <= f.d GROUP BY u.node)
SELECT f.conv_id, CAST(f.d AS BIGINT) AS depth, g.conv_id AS parent_conv_id, f.n AS n_convs, CAST(f.kids AS BIGINT) AS n_children,
  a.leaves AS n_leaves, CAST(a.saved AS BIGINT) AS saved_tokens, f.ends AS ends_sha256
FROM f JOIN a ON a.node = f.node LEFT JOIN f g ON g.node = f.parent"""
