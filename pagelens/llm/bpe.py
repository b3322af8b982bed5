"""Byte-level BPE by depth-first traversal of a trie of distinct words."""

import struct

from pagelens.llm.encoding import Memo, byte_characters, documents, gather, kept_in_worker, parts_of, sums, text_slices

# Fixed values of the byte-level pre-tokenizer: how a text is cut before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Merges:
    """Vocabulary and merges of a tokenizer file, and the test whether two tokens may stand side by side."""

    def __init__(self, path):
        import json
        import ahocorasick
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = {c: b for b, c in byte_characters().items()}
        self.vocabulary = {bytes(map(byte_of.__getitem__, text)): i for text, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text = {i: token for token, i in self.vocabulary.items()}
        self.text.update({i: content.encode() for content, i in self.special.items()})
        self.rank = dict.fromkeys(self.vocabulary.values(), -1)
        self.halves, self.merged = {}, {}
        ids = spec["model"]["vocab"]
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            token = ids[left + right]
            self.halves[token] = (ids[left], ids[right])
            self.merged[ids[left], ids[right]] = token
            self.rank[token] = rank
        self.pairs, self.whole = {}, {}
        # All tokens that end at each place of a word are found at once; bytes are the characters of the same number.
        self.size = {token: len(text) for token, text in self.text.items()}
        self.ends = ahocorasick.Automaton()
        for text, token in self.vocabulary.items():
            self.ends.add_word(text.decode("latin-1"), (token, len(text)))
        self.ends.make_automaton()

    def apart(self, left, right, limit=float("inf"), own=None):
        """Whether no merge crosses the border, undoing the merges next to it from the last to the first."""
        rank = self.rank
        while True:
            token = self.merged.get((left, right))
            if token is not None and token != own and rank[token] < limit:
                return False
            if rank[left] > rank[right]:
                limit = rank[left]
                left = self.halves[left][1]
            elif rank[right] < 0:
                return True
            else:
                limit = rank[right] + 1  # On a tie the merge further left, the crossing one, comes first.
                right = self.halves[right][0]

    def reached(self, token):
        """Whether the bytes of a token are encoded as that token."""
        known = self.whole.get(token)
        if known is None:
            known = True
            if token in self.halves:
                left, right = self.halves[token]
                known = (self.reached(left) and self.reached(right)
                         and self.apart(left, right, self.rank[token], token))
            self.whole[token] = known
        return known

    def encode_words(self, words):
        """Ids of each distinct word, as a dictionary.

        Sorted words are the depth-first order of their trie, and the stack is the path to the current
        node. A node's state is the last token of the encoding of its prefix: the one token that ends
        here and may follow the state of the node where it begins. Words with a common prefix share the
        states of that prefix.
        """
        found, last, path = {}, [-1], ""
        pairs, size, ends = self.pairs, self.size, self.ends.iter
        for word, raw in sorted((w if w.isascii() else w.encode().decode("latin-1"), w) for w in words):
            if word.startswith(path):
                known = len(path)
            else:
                known, most = 0, min(len(word), len(path))
                while known < most and word[known] == path[known]:
                    known += 1
                del last[known + 1:]
            for end, (token, length) in ends(word):
                if end < known:
                    continue
                before = last[end + 1 - length]
                key = before << 20 | token
                fits = pairs.get(key)
                if fits is None:
                    fits = pairs[key] = self.reached(token) and (before < 0 or self.apart(before, token))
                if fits:
                    last.append(token)
                    known = end + 1
            path, ids, at = word, [], len(word)
            while at:
                token = last[at]
                ids.append(token)
                at -= size[token]
            ids.reverse()
            found[raw] = ids
        return found


# White space other than single blanks and line ends between other characters, or marks of special tokens.
UNEVEN = (r"[\x00\t\x0b-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
          r"|[ \n][ \n]|\A[ \n]|[ \n]\z|<\|")


class TrieEncoder:
    """Encode and decode texts; ``entries`` bounds the memory of known words, not the result.

    A blank between two characters that are not white space always begins a new piece, and a line end
    between two such characters is a piece of its own; so texts are looked up by the parts between
    them. A text with other white space or a special token goes through the pattern as a whole.
    """

    def __init__(self, path, entries=300_000):
        import re
        import regex
        self.merges = Merges(path)
        self.entries = entries
        self.pieces = regex.compile(PATTERN).findall
        special = "|".join(map(re.escape, self.merges.special)) or r"(?!)"
        self.specials = re.compile(f"({special})").split
        self.words, self.parts = {}, {}
        self.digits = Memo(str)

    def learn(self, words):
        for word, ids in self.merges.encode_words(set(words) - self.words.keys()).items():
            self.words[word] = struct.pack(f"<{len(ids)}I", *ids)

    def encode_uneven(self, text):
        found = []
        for k, piece in enumerate(self.specials(text)):
            if k % 2:
                found.append(struct.pack("<I", self.merges.special[piece]))
            else:
                words = self.pieces(piece)
                self.learn(words)
                found += map(self.words.__getitem__, words)
        return b"".join(found)

    def encode(self, texts):
        """Ids of an Arrow array of texts without NULLs: all ids in one array, and each text's number of ids."""
        import numpy as np
        import pyarrow.compute as pc
        if max(len(self.parts), len(self.words)) > self.entries:
            self.parts.clear()
            self.words.clear()
        if len(self.merges.pairs) > 2 * self.entries:
            self.merges.pairs.clear()
        uneven = pc.match_substring_regex(texts, UNEVEN).to_numpy(zero_copy_only=False)
        marked = pc.replace_substring(pc.replace_substring(pc.if_else(uneven, "", texts), " ", "\0 "), "\n", "\0\n\0")
        distinct, index, offsets = parts_of(marked, "\0")
        cut = {part: self.pieces(part) for part in distinct if part not in self.parts}
        self.learn(word for words in cut.values() for word in words)
        for part, words in cut.items():
            self.parts[part] = b"".join(map(self.words.__getitem__, words))
        ids, n = gather(list(map(self.parts.__getitem__, distinct)), index)
        n = sums(n, offsets)
        places = np.flatnonzero(uneven)
        if len(places):
            other = [np.frombuffer(self.encode_uneven(texts[i].as_py()), "<i4") for i in places.tolist()]
            rows = np.split(ids, np.cumsum(n)[:-1])
            for i, row in zip(places.tolist(), other):
                rows[i] = row
            ids, n = np.concatenate(rows), np.array([len(r) for r in rows])
        return ids, n

    def decode(self, ids):
        """Text of a sequence of ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.merges.text.__getitem__, ids)).decode("utf-8", "replace")

    def joined(self, ids):
        """Decimal ids with commas between them."""
        return ",".join(map(self.digits.__getitem__, ids))


def encode(docs, tokenizer, id_column="doc_id", text_column="text", slice_bytes=16 << 20):
    """Ids of every whole text: doc_id, tokens.

    Narrow: one pass over the table. NULL and empty texts have no ids; rows with equal or NULL document
    ids are encoded one by one; an empty table gives an empty result. ``slice_bytes`` bounds the text
    whose distinct words share a trie.
    """
    def run(batches):
        import numpy as np
        import pyarrow as pa
        encoder = kept_in_worker(TrieEncoder, tokenizer)
        for batch in batches:
            for keys, texts in text_slices(batch, slice_bytes):
                ids, n = encoder.encode(texts)
                ends = pa.array(np.concatenate([[0], np.cumsum(n)]).astype("int32"))
                yield pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(ends, pa.array(ids))], ["doc_id", "tokens"])

    return documents(docs, id_column, text_column).mapInArrow(run, "doc_id long, tokens array<int>")


def decode(encoded, tokenizer):
    """Texts of ids: doc_id, text. A NULL list gives NULL."""
    def run(batches):
        import pyarrow as pa
        encoder = kept_in_worker(TrieEncoder, tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                texts = [None if x is None else encoder.decode(x) for x in piece.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(texts, "string")], ["doc_id", "text"])

    return encoded.select("doc_id", "tokens").mapInArrow(run, "doc_id long, text string")


def round_trip(docs, tokenizer, id_column="doc_id", text_column="text", slice_bytes=16 << 20):
    """Encode and decode in one pass: doc_id, n_tokens, and hex digests of the ids joined by commas and of the
    decoded text. Same rules for special rows as ``encode``."""
    def run(batches):
        import hashlib
        import numpy as np
        import pyarrow as pa
        encoder = kept_in_worker(TrieEncoder, tokenizer)
        for batch in batches:
            for keys, texts in text_slices(batch, slice_bytes):
                ids, n = encoder.encode(texts)
                ids_hex, text_hex, ends = [], [], np.cumsum(n).tolist()
                for first, last in zip([0] + ends, ends):
                    row = ids[first:last].tolist()
                    ids_hex.append(hashlib.sha256(encoder.joined(row).encode()).hexdigest())
                    text_hex.append(hashlib.sha256(encoder.decode(row).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([keys, pa.array(n, "int64"), pa.array(ids_hex), pa.array(text_hex)],
                                                 ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return documents(docs, id_column, text_column).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
