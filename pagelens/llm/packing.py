"""Packing documents into training windows of several lengths."""

from pagelens.llm.encoding import WordEncoder, documents, kept_in_worker, text_slices, with_end

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "tier int, step_id long")


class Packer:
    """Windows of one task. ``tiers`` are window sizes in ascending order, powers of two.

    A document gives whole windows of the longest tier, and its rest is routed to the shortest tier that
    holds it. A tier's waiting pieces are packed as soon as they fill ``ahead`` windows: longest first,
    then the longest waiting piece that fits the gap, from the own tier or a shorter one; only if none
    fits is a piece cut, and its rest is routed anew. So every window is full. What is left at the end
    fills windows of ever smaller powers of two. Steps take as many windows of one tier as make
    ``step_tokens``; the last windows of all tiers are spread, longest first, over steps of nearly equal
    size.
    """

    def __init__(self, tiers, step_tokens, ahead, sequence, step):
        self.tiers, self.step_tokens, self.ahead = tiers, step_tokens, ahead
        self.sequence, self.step = sequence, step
        self.waiting = {t: [] for t in tiers}  # Sorted by length: (length, number, document, start).
        self.tokens = dict.fromkeys(tiers, 0)
        self.closed = {t: [] for t in tiers}
        self.number = 0
        self.rows = []

    def add(self, doc, n):
        """``doc`` is kept with its pieces until their windows close."""
        top, start = self.tiers[-1], 0
        while n - start >= top:
            self.close(top, [(top, 0, doc, start)])
            start += top
        if start < n:
            self.wait((n - start, self.number, doc, start))
            self.number += 1
        for tier in self.tiers:
            while self.tokens[tier] >= self.ahead * tier:
                self.window(tier, tier)

    def wait(self, piece):
        from bisect import insort
        tier = next(t for t in self.tiers if piece[0] <= t)
        insort(self.waiting[tier], piece, key=lambda p: (p[0], p[1]))
        self.tokens[tier] += piece[0]

    def take(self, tier, index):
        piece = self.waiting[tier].pop(index)
        self.tokens[tier] -= piece[0]
        return piece

    def window(self, size, tier):
        """Close a full window of ``size`` from the pieces of ``tier`` and shorter ones, then longer ones."""
        from bisect import bisect_right
        gap, pieces = size, []
        below = [t for t in reversed(self.tiers) if t <= tier]
        while gap:
            fits = next(((t, i - 1) for t in below if (i := bisect_right(self.waiting[t], gap, key=lambda p: p[0]))), None)
            if fits:
                piece = self.take(*fits)
            else:
                longer = next(t for t in [*reversed(below), *[t for t in self.tiers if t > tier]] if self.waiting[t])
                length, number, doc, start = self.take(longer, 0)
                piece = (gap, number, doc, start)
                self.wait((length - gap, number, doc, start + gap))
            pieces.append(piece)
            gap -= piece[0]
        self.close(size, pieces)

    def close(self, size, pieces):
        kept = self.closed.get(size)
        if kept is None:
            kept = self.closed.setdefault(size, [])
        kept.append((self.sequence, pieces))
        self.sequence += 1
        if size in self.tiers and len(kept) * size >= self.step_tokens:
            self.emit(size, kept)
            self.closed[size] = []

    def emit(self, size, windows):
        for sequence, pieces in windows:
            offset = 0
            for length, _, doc, start in pieces:
                self.rows.append((doc, start, length, sequence, offset, size, self.step))
                offset += length
        self.step += 1

    def finish(self):
        for tier in reversed(self.tiers):
            while sum(self.tokens.values()) >= tier:
                self.window(tier, self.tiers[-1])
        while left := sum(self.tokens.values()):
            self.window(1 << (left.bit_length() - 1), self.tiers[-1])
        rest = sorted(((size, w) for size, ws in self.closed.items() for w in ws), key=lambda x: (-x[0], x[1][0]))
        groups = [[0, i, []] for i in range(-(-sum(s for s, _ in rest) // self.step_tokens))]
        for size, window in rest:
            lightest = min(groups)
            lightest[0] += size
            lightest[2].append((size, window))
        for _, _, windows in groups:
            step = self.step
            for size, window in windows:
                self.emit(size, [window])
                self.step = step
            self.step = step + 1

    def drain(self):
        rows, self.rows = self.rows, []
        return rows


def pack(docs, tokenizer, end_id=1, tiers=(256, 512, 1024, 2048), step_tokens=16384, ahead=64, id_column="doc_id",
         text_column="text", with_tokens=False):
    """Pieces of every document in windows of at most the longest tier; each id lies in exactly one piece.

    Every task packs the documents of its own partition in their order, so nothing is shuffled and a
    task that runs again gives the same windows as long as its input has the same order, as files have.
    Memory: the waiting pieces of ``ahead`` windows and one open step per tier.

    NULL and empty texts are the end id alone; rows with equal or NULL ids are documents of their own;
    an empty table has no pieces. ``with_tokens`` adds the ids of each piece.
    """
    def run(batches):
        import zlib
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        encoder = kept_in_worker(WordEncoder, tokenizer)
        base = TaskContext.get().partitionId() << 32
        packer = Packer(tuple(tiers), step_tokens, ahead, base, base)

        def batch_of(rows):
            columns = [[], [], [], [], [], [], [], [], [], []]
            for (doc, ids), start, length, sequence, offset, size, step in rows:
                cut = ids[start:start + length]
                row = (doc, start, length, zlib.crc32(cut.tobytes()), len(ids), sequence, offset, size, step)
                for column, value in zip(columns, row):
                    column.append(value)
                if with_tokens:
                    columns[9].append(cut)
            types = ["int64"] * 7 + ["int32", "int64"] + [pa.list_(pa.int32())]
            names = [c.split()[0] for c in SCHEMA.split(", ")] + ["tokens"]
            used = 9 + with_tokens
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns[:used], types)], names[:used])

        for batch in batches:
            for keys, texts in text_slices(batch):
                ids, n = with_end(*encoder.encode(texts), end_id)
                ends = np.cumsum(n)
                for doc, first, last in zip(keys.to_pylist(), (ends - n).tolist(), ends.tolist()):
                    # A copy, so that a waiting piece keeps its own document alive and not the whole slice.
                    packer.add((doc, ids[first:last].copy()), last - first)
                    if len(packer.rows) >= 4096:
                        yield batch_of(packer.drain())
        packer.finish()
        if packer.rows:
            yield batch_of(packer.drain())

    return documents(docs, id_column, text_column).mapInArrow(
        run, SCHEMA + ", tokens array<int>" * with_tokens)
