import random
import re
import string
import unicodedata
from urllib.parse import urlsplit, urlparse

from pyspark.sql import functions as F

from pagelens.functions import text as tx, url as u, vectors as v

TITLES = ["", "   ", "a b", "a b  c", "x²y³ ④", "٣٤ digits 5", "emoji 🙂 ok", "tab\tnew\nline\x1fsep", " é. - !",
          "１２ full", "a​b", "\x85x\x0b", "ﬁne ½ Ⅷ ㎏ ß œ"]


def random_texts(n, seed):
    rng = random.Random(seed)
    pools = [range(32, 127), range(0, 0x250), range(0x300, 0x370), range(0x2000, 0x2600), range(0x3000, 0x3400),
             range(0xF900, 0xFFFE), range(0x1D400, 0x1D800)]
    return ["".join(chr(rng.choice(rng.choice(pools))) for _ in range(rng.randrange(0, 40))) for _ in range(n)]


def test_counts_follow_python(rows):
    texts = TITLES + random_texts(500, 1)
    df = rows([(t,) for t in texts], "t string")
    c = F.col("t")
    out = df.select("t", tx.digit_count(c).alias("digits"), tx.punctuation_count(c).alias("marks"), tx.word_count(c).alias("n"),
                    tx.average_word_length(c).alias("mean"), tx.strip(c).alias("stripped"), tx.words(c).alias("words"),
                    tx.collapse_blanks(c).alias("collapsed")).collect()
    for r in out:
        words = r.t.split()
        assert r.digits == sum(ch.isdigit() for ch in r.t)
        assert r.marks == sum(ch in string.punctuation for ch in r.t)
        assert (r.n, r.words) == (len(words), words)
        assert abs(r["mean"] - (sum(map(len, words)) / len(words) if words else 0)) < 1e-12
        assert r.stripped == r.t.strip()
        assert r.collapsed == " ".join(words)


def test_fold_to_ascii_follows_python(rows):
    texts = TITLES + random_texts(800, 2)
    out = rows([(t,) for t in texts], "t string").select("t", tx.fold_to_ascii(F.col("t")).alias("f")).collect()
    for r in out:
        assert r.f == unicodedata.normalize("NFKD", r.t).encode("ascii", "ignore").decode()


def one(rows, function, *texts):
    df = rows([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.x for r in df.select("i", function(F.col("t")).alias("x")).orderBy("i").collect()]


def test_each_cleaning_step(rows):
    assert one(rows, tx.map_characters, "€5 £ ¥ ©®™ •…—–‘’“”«»¿¡ 5° áéíóúüñç", "plain") == [
        "EUR5 GBP JPY (c)(R)(TM) *...--''\"\"<<>>?! 5 degrees  aeiouunc", "plain"]
    assert one(rows, tx.line_breaks_to_blanks, "a\r\nb\tc") == ["a  b c"]
    assert one(rows, tx.fold_structures, "x Array (1, 2) y {a: 1} z", "Array(") == ["x [array] y [object] z", "Array("]
    assert one(rows, tx.drop_markup, "a<b>c</b>d < e", "1 < 2") == ["a c d < e", "1 < 2"]
    assert one(rows, tx.drop_controls, "a\x00b\x1fc\x7f") == ["abc\x7f"]
    assert one(rows, tx.double_quotes, 'say "x"') == ['say ""x""']
    assert one(rows, tx.drop_all_controls, "a\x7fb\x01") == ["ab"]
    assert one(rows, lambda c: F.char_length(tx.shorten_long(c)), "a" * 5000, "a" * 5001) == [5000, 1000]


def test_sanitised_text_is_ascii_and_complete(rows):
    data = [(0, None), (1, ""), (2, ' <p>Café "nöel" {x: 1}</p>\n'), (3, "é" * 6000)] + [
        (i + 4, t) for i, t in enumerate(random_texts(200, 3))]
    out = {r.i: r.t for r in tx.with_sanitised(rows(data, "i int, t string"), "t").collect()}
    assert out[0] == out[1] == ""
    assert out[2] == 'Cafe ""noel"" [object]'
    assert out[3] == "e" * 997 + "..."
    assert all(re.fullmatch(r"[\x20-\x7e]*", t) for t in out.values())
    kept = tx.with_sanitised(rows([('a "b"',)], "t string"), "t", csv_quotes=False).first()
    assert kept.t == 'a "b"'


URLS = ["http://u:p@H.com:80/x;p?q=1&&b#f", "//h/x", "h.com/x", "http://a b/", "http://münchen.de/x", "mailto:x@y?z=1",
        "http://h.com/a;b/c;d", "https://x.org", "https://x.org/?a=1&b=2", "ftp://f/p;type=a", "http://h//a//b/", "", "a:b:c",
        "http://h/p?q?r=1#f?g", "1http://x/y", "foo://h/x;y"]


def test_url_parts_follow_python(rows):
    c = F.col("t")
    out = rows([(t,) for t in URLS], "t string").select(
        "t", u.domain(c).alias("domain"), u.path(c).alias("path"), u.query(c).alias("query"), u.path_depth(c).alias("depth"),
        u.query_count(c).alias("n"), u.scheme(c).alias("scheme")).collect()
    for r in out:
        want = urlparse(r.t)
        assert (r.domain, r.path, r.query) == (want.netloc, want.path, want.query), r.t
        assert r.depth == len([s for s in want.path.split("/") if s])
        assert r.n == (len(want.query.split("&")) if want.query else 0)
        assert r.scheme == urlsplit(r.t).scheme


def test_model_texts(rows):
    assert one(rows, lambda c: tx.split_first(c), "https://x:y", "none") == [["https", "//x:y"], ["none"]]
    assert one(rows, lambda c: tx.tokens(c, 3), "A-b: c d") == [["a", "-", "b"]]
    assert one(rows, lambda c: tx.model_text(c, F.lit("T"), ": "), "u") == ["u: T"]


def test_numbers_follow_python(rows):
    values = [0.0005, 0.0015, 0.0625, 1.9499999999, 0.125, 2.675, 1e6 + 0.0005, -0.0625, 0.5, 1 / 3]
    out = rows([(x,) for x in values], "x double").select(
        "x", v.rounded(F.col("x"), 3).alias("r"), v.percent(F.col("x"), 1).alias("p"), v.sigmoid(F.col("x")).alias("s"),
        v.threshold(F.col("x")).alias("a"), v.threshold(F.col("x"), inclusive=False).alias("b")).collect()
    for r in out:
        assert r.r == round(r.x, 3)
        assert r.p == f"{r.x * 100:.1f}%"
        assert (r.a, r.b) == (int(r.x >= 0.5), int(r.x > 0.5))
    assert rows([(1234567,)], "n int").select(v.thousands(F.col("n")).alias("t")).first().t == "1,234,567"


def test_vectors(rows):
    df = rows([([3.0, 4.0],), ([0.0, 0.0],)], "x array<double>")
    out = df.select(v.norm(F.col("x")).alias("n"), v.unit(F.col("x")).alias("u"), v.dot(F.col("x"), F.col("x")).alias("d")).collect()
    assert [r.n for r in out] == [5.0, 0.0]
    assert out[0].u == [0.6, 0.8] and out[1].u is None
    assert out[0].d == 25.0
