"""Jaccard self-join of word shingles by prefix filtering, and the groups that its links form.

Texts with equal shingle sets are one node, named by a digest of the set. A set's shingles are ordered
rarest first, by their counts over all documents (in a table of fixed size, so equal shingles always
have equal counts). Two sets that are similar enough share a shingle of their prefixes; such pairs pass
length, positional and suffix filters, and the rest is verified with the whole sets, once per pair.

The groups are found first, and there pairs of nodes that are known to be connected are not looked at
again: first every node meets the smallest node of each prefix shingle, then a neighbour in an order
that differs from shingle to shingle, at last every node of another group. The last step leaves no
group apart that a link joins.

All links lie inside the groups. Where they are asked for, the whole sets of each group are cut into
blocks, and every pair of its nodes is compared once, in the one cell that has both their blocks.
"""

from pyspark.sql import Window, functions as F

from pagelens.llm.components import components
from pagelens.llm.encoding import documents, text_slices, with_types
from pagelens.llm.shingles import shingle_sets
from pagelens.session import ensure_checkpoint_dir, shared_folder

SLOTS = 1 << 18  # Counters of shingles: 2 MB on the driver and in each task, for any input.
BLOCK = 1 << 12
SLICE = 1 << 20  # Bytes of text that are cut into shingles at a time.
BINS = 64  # The suffix filter compares how many shingles fall into each part of the hash range.
FINE = [(1 << 14, 12), (1 << 12, 10), (1 << 10, 8)]  # So many shingles or more: also 2 ** bits parts, as 64 tell long sets badly apart.
CELL = 1 << 17  # Shingles in a block of a group's sets, about; a set is never cut.
CELL_NODES = 1 << 10  # Nodes in a block, about.
WIDTH = 1 << 10  # Shingles that a cell multiplies at a time.
NEEDED_BITS = 24  # Before the exact join, whole sets are looked up in a bit table of 2 ** this many bits: 2 MB.


def digest(grams):
    import hashlib
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def stored(df, name):
    """Write a table to the shared folder and read it again: later steps start from its files."""
    folder = shared_folder(df.sparkSession, f"jaccard-{name}-")
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def profile(texts, size):
    """Per document doc_id, n, node, bins and, of long sets, fine ones; at the end of each task its shingle counts, in blocks of BLOCK counters."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        counts = np.zeros(SLOTS, "int64")
        names = ["doc_id", "n", "node", "bins", "fine", "block", "counts"]
        types = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int16()), pa.list_(pa.int16()), pa.int32(), pa.binary()]

        def parts(grams, bits):
            return np.minimum(np.bincount((grams >> np.uint64(64 - bits)).astype("int64"), minlength=1 << bits), 32767).astype("int16")


        def table(*columns):
            rows = max(map(len, columns))
            return pa.RecordBatch.from_arrays([pa.array(c, t) if len(c) else pa.nulls(rows, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            for keys, found in text_slices(batch, SLICE):
                n, nodes, bins, fine = [], [], [], []
                for grams in shingle_sets(found, size):
                    n.append(len(grams))
                    nodes.append(digest(grams) if len(grams) else None)
                    bins.append(parts(grams, BINS.bit_length() - 1))
                    fine.append(next((parts(grams, bits) for least, bits in FINE if len(grams) >= least), None))
                    np.add.at(counts, (grams & np.uint64(SLOTS - 1)).astype("int64"), 1)
                yield table(keys, n, nodes, bins, fine, [], [])
        for block in range(SLOTS // BLOCK):
            yield table([], [], [], [], [], [block], [counts[block * BLOCK:(block + 1) * BLOCK].astype("<i8").tobytes()])

    return texts.mapInArrow(run, "doc_id long, n long, node binary, bins array<smallint>, fine array<smallint>, block int, counts binary")


def total_counts(profiled):
    """Sum of all tasks' counters: each block is added up as a stream, SLOTS numbers reach the driver."""
    import numpy as np

    def run(batches):
        import pyarrow as pa
        totals = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = np.frombuffer(counts.as_py(), "<i8")
                totals[block] = totals[block] + found if block in totals else found
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), "int32"), pa.array([v.tobytes() for v in totals.values()], "binary")],
                                         ["block", "counts"])

    blocks = profiled.filter("block IS NOT NULL").select("block", "counts").repartition(SLOTS // BLOCK, "block")
    counts = np.zeros(SLOTS, "int64")
    for row in blocks.mapInArrow(run, "block int, counts binary").collect():
        counts[row.block * BLOCK:(row.block + 1) * BLOCK] = np.frombuffer(row.counts, "<i8")
    return counts


def prefixes(texts, size, percent, counts):
    """Prefix shingles of each set that a task meets: gram, node, n, pos (place in the rare-first order)."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        often, seen = counts.value, set()
        for batch in batches:
            for _, found in text_slices(batch, SLICE):
                grams_of, nodes, n_of, pos_of = [], [], [], []
                for grams in shingle_sets(found, size):
                    n = len(grams)
                    node = digest(grams) if n else None
                    if node is None or node in seen:
                        continue
                    seen.add(node)
                    keep = n - -(-percent * n // 100) + 1
                    order = np.lexsort((grams, often[(grams & np.uint64(SLOTS - 1)).astype("int64")]))[:keep]
                    grams_of.append(grams[order].view("int64"))
                    nodes += [node] * len(order)
                    n_of.append(np.full(len(order), n, "int32"))
                    pos_of.append(np.arange(len(order), dtype="int32"))
                if nodes:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(grams_of)), pa.array(nodes, "binary"), pa.array(np.concatenate(n_of)),
                                                      pa.array(np.concatenate(pos_of))], ["gram", "node", "n", "pos"])

    return texts.mapInArrow(run, "gram long, node binary, n int, pos int")


def shared_prefixes(texts, size, percent, counts):
    """Prefix shingles that more than one node has: gram, node, n, pos, and the same of the smallest node as ``least``.

    Every row carries its node, so n and pos are those of the node whatever ids the texts have.
    """
    partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_gram = Window.partitionBy("gram")
    places = prefixes(texts, size, percent, counts).repartition(partitions, "gram")
    places = places.withColumn("least", F.min(F.struct("node", "n", "pos")).over(by_gram)).withColumn("_last", F.max("node").over(by_gram))
    return places.filter("least.node <> _last").select("gram", "node", "n", "pos", "least").dropDuplicates(["gram", "node"])


def whole_sets(texts, size, needed):
    """Node and all its shingles for the nodes in the bit table ``needed`` (and a few others)."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        bits, seen = needed.value, set()
        for batch in batches:
            for _, found in text_slices(batch, SLICE):
                nodes, sets = [], []
                for grams in shingle_sets(found, size):
                    node = digest(grams)
                    if not len(grams) or node in seen:
                        continue
                    place = int.from_bytes(node[:4], "big") >> (32 - NEEDED_BITS)
                    if bits[place >> 3] >> (place & 7) & 1:
                        seen.add(node)
                        nodes.append(node)
                        sets.append(grams.view("int64"))
                if nodes:
                    ends = np.cumsum([0] + [len(s) for s in sets]).astype("int32")
                    yield pa.RecordBatch.from_arrays([pa.array(nodes, "binary"), pa.ListArray.from_arrays(
                        pa.array(ends), pa.array(np.concatenate(sets)))], ["node", "grams"])

    return texts.mapInArrow(run, "node binary, grams array<long>")


def enough(common, n1, n2, percent):
    """common >= percent / 100 * union, in integers."""
    return (100 + percent) * common >= percent * (n1 + n2)


def plausible(x, y, percent):
    """Length and positional filter for two places of one shingle, structs of n and pos."""
    long = lambda c: c.cast("long")
    n1, n2 = long(x["n"]), long(y["n"])
    most = F.least(n1 - x["pos"], n2 - y["pos"])
    return (100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)) & enough(most, n1, n2, percent)


def suffix_filter(x, y, n1, n2, percent):
    """The sets share at most the smaller number in each part of the hash range; for parts that are too full to
    be counted nothing is concluded."""
    full = F.exists(F.concat(x, y), lambda v: v == 32767)
    common = F.aggregate(F.zip_with(x, y, lambda p, q: F.least(p, q).cast("long")), F.lit(0).cast("long"), lambda s, v: s + v)
    return full | enough(common, n1, n2, percent)


def grouped(docs, percent, size, id_column, text_column):
    """Texts, members (doc_id, n, node) and nodes (node, n, rep, copies, label of the group) of a table."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    texts = documents(docs, id_column, text_column)
    profiled = stored(profile(texts, size), "profile")
    counts = spark.sparkContext.broadcast(total_counts(profiled))  # SLOTS counters, for any input.
    members = profiled.filter("block IS NULL").select("doc_id", "n", "node", "bins", "fine")
    nodes = stored(members.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("bins").alias("bins"), F.first("fine").alias("fine")), "nodes")
    shared = stored(shared_prefixes(texts, size, percent, counts), "prefixes")
    links = joined(texts, shared, nodes.select("node", "n", "bins", "fine"), size, percent)
    named = nodes.join(components(links), "node", "left").withColumn("label", F.coalesce("label", "node"))
    return texts, members, named.select("node", "n", "rep", "copies", "label")


def similar_groups(docs, percent=80, size=5, id_column="doc_id", text_column="text", links=False):
    """One row per document: doc_id, n_shingles, node (digest of its set), component_id (the smallest document id
    that links reach), copies (documents with the same set), first (its id is the component's and its set the
    one of smallest digest that has this id); with ``links`` also n_links (other documents that are similar
    enough, copies among them).

    Texts without words, empty and NULL texts have no shingles, link with nothing, and are their own
    component. Rows with equal ids keep a row each. A NULL id counts as larger than all others, so it
    names a component only when all its ids are NULL. Extra columns are left behind; an empty table
    gives an empty result. Without ``links`` only the links that connect the groups are looked for.
    """
    texts, members, nodes = grouped(docs, percent, size, id_column, text_column)
    first = F.min(F.struct(F.col("rep").isNull(), "rep", "node"))["node"]
    smallest = nodes.groupBy("label").agg(F.min("rep").alias("component_id"), first.alias("_first"))
    named = nodes.join(smallest, "label").select("node", "copies", "component_id", (F.col("node") == F.col("_first")).alias("_leads"))
    more = []
    if links:
        number = compared(texts, nodes, size, percent, "counts").groupBy("node").agg(F.sum("n_links").alias("_others"))
        named = named.join(number, "node", "left").withColumn("n_links", F.coalesce("_others", F.lit(0)) + F.col("copies") - 1)
        more = [F.coalesce("n_links", F.lit(0)).alias("n_links")]
    return members.join(named, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), "node", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("copies", F.lit(1)).alias("copies"),
        F.coalesce(F.col("_leads") & F.col("doc_id").eqNullSafe(F.col("component_id")), F.lit(True)).alias("first"), *more)


def similar_pairs(docs, percent=80, size=5, id_column="doc_id", text_column="text"):
    """Every pair of different sets that are similar enough, once: a, b (digests, a < b), n_a, n_b, n_common,
    copies_a, copies_b. The documents of a set are the rows of ``similar_groups`` with its node; copies are
    similar to each other without a row here."""
    texts, _, nodes = grouped(docs, percent, size, id_column, text_column)
    return compared(texts, nodes, size, percent, "pairs")


def cells(nodes):
    """The cells of each node of a group of several: node, copies, label, i, j, first (its block is i), second (it is j)."""
    total = nodes.groupBy("label").agg(F.sum("n").alias("_sum"), F.count(F.lit(1)).alias("_nodes")).filter("_nodes > 1")
    blocks = F.greatest(F.ceil(F.col("_sum") / CELL), F.ceil(F.col("_nodes") / CELL_NODES)).cast("long")
    block, other = F.pmod(F.xxhash64("node"), F.col("_blocks")).alias("_block"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)).alias("_other")
    placed = nodes.join(total.select("label", blocks.alias("_blocks")), "label").select("node", "copies", "label", block, other)
    placed = placed.withColumn("i", F.least("_block", "_other")).withColumn("j", F.greatest("_block", "_other"))
    return placed.select("node", "copies", "label", "i", "j", (F.col("_block") == F.col("i")).alias("first"), (F.col("_block") == F.col("j")).alias("second"))


def common_shingles(sets, first, second):
    """Numbers of common shingles of the sets at the places ``first`` with those at ``second``."""
    import numpy as np
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = times > 1
    keep = often[place]
    row, column = row[keep], (np.cumsum(often) - 1)[place[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    found = np.zeros((len(first), len(second)), "int64")
    for start in range(0, int(often.sum()), WIDTH):
        a, b = np.searchsorted(column, (start, start + WIDTH))
        dense = np.zeros((len(sets), WIDTH), "float32")
        dense[row[a:b], column[a:b] - start] = 1
        found += (dense[first] @ dense[second].T).astype("int64")  # At most WIDTH, so exact.
    return found


def compared(texts, nodes, size, percent, result):
    """All pairs of different nodes of each group by their whole sets, each pair once. ``result`` is "pairs", or
    "counts": node and n_links, to be added up, the documents of the other nodes it links with."""
    schema = {"counts": "node binary, n_links long",
              "pairs": "a binary, b binary, n_a long, n_b long, n_common long, copies_a long, copies_b long"}[result]
    partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = stored(cells(nodes), "cells")
    needed = texts.sparkSession.sparkContext.broadcast(bit_table(placed.select(F.col("node").alias("a"), F.col("node").alias("b"))))
    sets = whole_sets(texts, size, needed).dropDuplicates(["node"])
    rows = placed.join(sets, "node").repartition(partitions, "label", "i", "j").sortWithinPartitions("label", "i", "j")

    def cell(found):
        import numpy as np
        import pyarrow as pa
        nodes, copies, sets, first, second = zip(*found)
        copies, n = np.array(copies), np.array([len(s) for s in sets])
        first, second = np.flatnonzero(first), np.flatnonzero(second)
        common = common_shingles(sets, first, second)
        similar = (100 + percent) * common >= percent * (n[first][:, None] + n[second])
        if np.array_equal(first, second):
            similar &= np.arange(len(first))[:, None] < np.arange(len(second))
        x, y = np.nonzero(similar)
        if result == "counts":
            total = np.zeros(len(nodes), "int64")
            np.add.at(total, first[x], copies[second[y]])
            np.add.at(total, second[y], copies[first[x]])
            return [pa.RecordBatch.from_arrays([pa.array(nodes, "binary"), pa.array(total)], ["node", "n_links"])]
        number = common[x, y]
        x, y = first[x], second[y]
        swap = np.array([nodes[a] > nodes[b] for a, b in zip(x, y)], bool)
        x, y = np.where(swap, y, x), np.where(swap, x, y)
        columns = [pa.array([nodes[a] for a in x], "binary"), pa.array([nodes[b] for b in y], "binary"),
                   *map(pa.array, (n[x], n[y], number, copies[x], copies[y]))]
        whole = pa.RecordBatch.from_arrays(columns, ["a", "b", "n_a", "n_b", "n_common", "copies_a", "copies_b"])
        return [whole.slice(at, 10000) for at in range(0, whole.num_rows, 10000)]

    def run(batches):
        now, found = None, []
        for batch in batches:
            lists = batch.column("grams")
            for k, (label, i, j, *row) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("label", "i", "j", "node", "copies", "first", "second")])):
                if now != (label, i, j):
                    if found:
                        yield from cell(found)
                    now, found = (label, i, j), []
                node, copies, first, second = row
                found.append((node, copies, lists[k].values.to_numpy(), first, second))
        if found:
            yield from cell(found)

    return rows.mapInArrow(run, schema)


def with_nodes(docs, columns, size=5, text_column="text"):
    """The ``columns`` of every row, the text among them, and node, the digest of its set, NULL where the text has no
    shingles. A text travels to the task once."""
    rows = docs.select(F.struct(*columns).alias("_row"))
    place = list(columns).index(text_column)

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            at = 0
            row = batch.column(0)
            texts = pa.RecordBatch.from_arrays([pa.nulls(len(row)), row.field(place).cast(pa.string())], ["key", "text"])
            for keys, found in text_slices(texts, SLICE):
                digests = [digest(grams) if len(grams) else None for grams in shingle_sets(found, size)]
                yield pa.RecordBatch.from_arrays([pa.array(digests, "binary"), row.slice(at, len(keys))], ["node", "_row"])
                at += len(keys)

    return rows.mapInArrow(run, with_types(rows, "node binary", "_row")).select("_row.*", "node")


def bit_table(pairs):
    """A bit for the first bits of every node in the pairs: the words of 64 bits that are not 0 reach the driver."""
    import numpy as np
    place = F.conv(F.substring(F.hex("node"), 1, 8), 16, 10).cast("long")
    place = F.shiftright(place, 32 - NEEDED_BITS).cast("int").alias("place")
    both = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node")))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place").bitwiseAND(63))
    words = both.select(place).groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toPandas()
    bits = np.zeros(1 << (NEEDED_BITS - 6), "<i8")
    bits[words["word"].to_numpy("int64")] = words["bits"].to_numpy("int64")
    return bits.view("uint8")


def verified(texts, pairs, size, percent):
    """The pairs whose whole sets are similar enough."""
    needed = pairs.sparkSession.sparkContext.broadcast(bit_table(pairs))
    sets = stored(whole_sets(texts, size, needed).dropDuplicates(["node"]), "sets")  # Both joins read it: the texts are cut once.
    pairs = pairs.join(sets.select(F.col("node").alias("a"), F.col("grams").alias("x")), "a")
    pairs = pairs.join(sets.select(F.col("node").alias("b"), F.col("grams").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    return stored(pairs.filter(enough(common.cast("long"), F.size("x"), F.size("y"), percent)).select("a", "b"), "links")


def joined(texts, shared, nodes, size, percent):
    """Links between nodes: all that are needed to connect what the complete join connects."""
    def with_bins(pairs):
        for side in ("a", "b"):
            pairs = pairs.join(nodes.select(F.col("node").alias(side), F.struct("n", "bins").alias(f"_{side}")), side)
        return pairs.filter(suffix_filter(F.col("_a.bins"), F.col("_b.bins"), F.col("_a.n"), F.col("_b.n"), percent)).select("a", "b")

    def with_fine(pairs):
        """Without the pairs of long sets that their fine bins tell apart; nothing is concluded from unequal numbers of them."""
        long = nodes.filter("fine IS NOT NULL")
        for side in ("a", "b"):
            pairs = pairs.join(long.select(F.col("node").alias(side), F.struct("n", "fine").alias(f"_{side}")), side, "left")
        alike = suffix_filter(F.col("_a.fine"), F.col("_b.fine"), F.col("_a.n"), F.col("_b.n"), percent)
        return pairs.filter(F.when(F.size("_a.fine") == F.size("_b.fine"), alike).otherwise(True)).select("a", "b")

    def labelled(rows, labels):
        return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))

    def checked(pairs, tried):
        """Pairs that pass the filters and were not tried before, and those of them that are links."""
        pairs = pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stored(with_fine(with_bins(pairs)), "pairs")
        return pairs, verified(texts, pairs, size, percent)

    x, least = F.struct("node", "n", "pos").alias("x"), F.col("least").alias("y")
    first = shared.select(x, least).filter((F.col("x.node") != F.col("y.node")) & plausible(F.col("x"), F.col("y"), percent))
    tried, links = checked(first, None)

    by_gram = Window.partitionBy("gram")
    mixed = by_gram.orderBy(F.xxhash64("gram", "node"))
    place = F.struct("node", "label", "n", "pos")
    other = [F.lag(place, k).over(mixed) for k in (1, 2)] + [F.min(F.struct(F.xxhash64("node").alias("_h"), place.alias("place"))).over(by_gram)["place"]]
    rows = labelled(shared.drop("least"), components(links)).select(
        "gram", place.alias("x"), F.array(*other).alias("_others"), F.min("label").over(by_gram).alias("_from"), F.max("label").over(by_gram).alias("_to"))
    useful = F.filter("_others", lambda y: (y["label"] != F.col("x.label")) & plausible(F.col("x"), y, percent))
    # Shingles whose nodes are all connected by now are done with.
    rows = stored(rows.filter("_from <> _to").select("gram", "x", F.transform(useful, lambda y: y["node"]).alias("others")), "open")
    second = rows.select("x", F.explode("others").alias("_node")).select("x", F.struct(F.col("_node").alias("node")).alias("y"))
    pairs, found = checked(second, tried)
    tried, links = tried.union(pairs), links.union(found)
    labels = components(links)
    left = labelled(rows.select("gram", "x.node", "x.n", "x.pos"), labels).join(nodes.select("node", "bins"), "node")
    x = left.select("gram", F.struct("node", "label", "n", "pos", "bins").alias("x"))
    y = left.select("gram", F.struct("node", "label", "n", "pos", "bins").alias("y"))
    pairs = x.join(y, (x["gram"] == y["gram"]) & (F.col("x.node") < F.col("y.node")) & (F.col("x.label") != F.col("y.label"))
                   & plausible(F.col("x"), F.col("y"), percent)
                   & suffix_filter(F.col("x.bins"), F.col("y.bins"), F.col("x.n"), F.col("y.n"), percent))
    pairs = pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")
    pairs = stored(with_fine(pairs), "pairs")
    return links.union(verified(texts, pairs, size, percent))
