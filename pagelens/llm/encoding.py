"""Encoding whole texts with a vocabulary file of the tokenizers library, each distinct word once per task."""

import re
import struct

# Text made of these characters is in composed form, and its lower case depends on no neighbour.
PLAIN = "^[!-~À-ɏ]*$"
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|[0-9]|(?:(?![^\W\d_])[^\s0-9])+|\n").findall


def byte_characters():
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


def kept_in_worker(make, *arguments):
    """What ``make`` gives for these arguments, made once in a worker process: later tasks there use it again.

    Functions travel with their code, so each task has globals of its own; the store is a module of its own.
    """
    import sys
    import types
    store = vars(sys.modules.setdefault("pagelens_worker_store", types.ModuleType("pagelens_worker_store")))
    key = repr((make.__name__, arguments))
    if key not in store:
        store[key] = make(*arguments)
    return store[key]


def small_batches(spark, rows=2000):
    """At most so many rows in an Arrow batch of this session from now on, as each holds a whole text or its ids."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


class Memo(dict):
    """A dictionary that computes missing values."""

    def __init__(self, compute):
        super().__init__()
        self.compute = compute

    def __missing__(self, key):
        value = self[key] = self.compute(key)
        return value


def text_slices(batch, most=8 << 20):
    """Cut an Arrow batch of (key, text) so that a slice has at most ``most`` bytes of text, or one row."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    texts = batch.column(1).cast(pa.large_string()) if batch.num_rows else batch.column(1)
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype("int64")) if batch.num_rows else []
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.column(0).slice(at, stop - at), texts.slice(at, stop - at).fill_null("")
        at = stop


def gather(lists, index):
    """The rows ``index`` of a list of byte strings of 32-bit ids: all ids, and how many each row has."""
    import numpy as np
    sizes = np.array([len(x) // 4 for x in lists], "int64")
    return ragged(np.frombuffer(b"".join(lists), "<i4"), np.cumsum(sizes) - sizes, sizes, index)


def ragged(flat, firsts, sizes, index):
    """The rows ``index`` of lists that lie in ``flat``: all values, and how many each row has."""
    import numpy as np
    n = sizes[index]
    shift = firsts[index] - (np.cumsum(n) - n)
    return flat[np.repeat(shift, n) + np.arange(int(n.sum()))], n


def parts_of(texts, separator):
    """Distinct parts of an Arrow array of texts, the part at each place, and the first place of each text."""
    import pyarrow.compute as pc
    split = pc.split_pattern(texts, separator)
    coded = split.flatten().dictionary_encode()
    offsets = split.offsets.to_numpy()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), offsets - offsets[0]


def sums(n, offsets):
    """Sums of ``n`` between neighbouring offsets."""
    import numpy as np
    ends = np.concatenate([[0], np.cumsum(n)])
    return ends[offsets[1:]] - ends[offsets[:-1]]


class WordEncoder:
    """Ids of texts under the word vocabulary in ``path``.

    Words never reach over a blank, so a text's ids are those of its parts between blanks, one after
    the other. Parts of plain characters are cut into words here, all distinct ones at once, and each distinct word
    goes through the library's merges; any other part goes through the whole library. ``entries`` bounds the
    memory of known words, not the result.
    """

    def __init__(self, path, entries=300_000):
        from tokenizers import Tokenizer
        self.full = Tokenizer.from_file(path)
        self.model = self.full.model
        self.characters = byte_characters()
        self.entries = entries
        self.words = Memo(self.encode_word)

    def encode_word(self, word):
        if not word.isascii():
            word = "".join(map(self.characters.__getitem__, word.encode()))
        ids = [token.id for token in self.model.tokenize(word)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode_whole(self, part):
        ids = self.full.encode(part, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode_parts(self, parts):
        """Ids of an Arrow array of texts without blanks: all ids in one array, and each part's first place and number."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        plain = pc.and_not(pc.match_substring_regex(parts, PLAIN), pc.match_substring(parts, "<|")).to_numpy(zero_copy_only=False)
        cut = pa.array(PIECES("\n".join(parts.filter(pa.array(plain)).to_pylist()).lower()), pa.string()).dictionary_encode()
        words, codes = cut.dictionary.to_pylist(), cut.indices.to_numpy()
        ids, n = gather([b"" if w == "\n" else self.words[w] for w in words], codes)
        ends = np.cumsum(n)
        borders = np.flatnonzero(codes == words.index("\n")) if "\n" in words else np.zeros(0, "int64")
        bounds = np.concatenate([[0], ends[borders], [len(ids)]]).astype("int64")
        others = [self.encode_whole(part) for part in parts.filter(pa.array(~plain)).to_pylist()]
        firsts, sizes = np.zeros(len(parts), "int64"), np.zeros(len(parts), "int64")
        if plain.any():
            firsts[plain], sizes[plain] = bounds[:-1], np.diff(bounds)
        sizes[~plain] = [len(x) // 4 for x in others]
        firsts[~plain] = len(ids) + np.cumsum(sizes[~plain]) - sizes[~plain]
        if len(self.words) > self.entries:
            self.words.clear()
        return np.concatenate([ids, np.frombuffer(b"".join(others), "<i4")]), firsts, sizes

    def encode(self, texts):
        """Ids of an Arrow array of texts without NULLs: all ids in one array, and each text's number of ids."""
        import pyarrow.compute as pc
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        ids, n = ragged(*self.encode_parts(coded.dictionary), coded.indices.to_numpy())
        offsets = split.offsets.to_numpy()
        return ids, sums(n, offsets - offsets[0])


def with_end(ids, n, end_id):
    """Append ``end_id`` to every text's ids; also the new numbers of ids."""
    import numpy as np
    return np.insert(ids, np.cumsum(n), end_id), n + 1


def documents(docs, id_column="doc_id", text_column="text", carried=()):
    """The id and whole text of every document; other columns, whatever their names, are left behind, but for
    ``carried``, which come along in a struct of that name."""
    return docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].cast("string").alias("text"), *struct_of(docs, carried))


def struct_of(docs, carried):
    """A list of one struct column ``carried``, or of none."""
    from pyspark.sql import functions as F
    return [F.struct(*[docs[c] for c in carried]).alias("carried")] if carried else []


def with_types(rows, schema, *names):
    """``schema`` and the types that ``rows`` has for ``names``, as DDL."""
    return ", ".join([schema, *[f"{name} {rows.schema[name].dataType.simpleString()}" for name in names]])
