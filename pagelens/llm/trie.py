"""Prefix trie of conversations: one node for each distinct beginning, with counts of its subtree.

A turn is named by a 128-bit digest of its role and text, a conversation by the digests of its turns one
after the other, its path. Conversations are dealt by ranges of (path, conv_id), so a shard has a
contiguous piece of the trie's leaves, and only the nodes on the two paths at its limits go on in other
shards. Every shard knows the last path before it and the first one after it and counts each thing once:
a node where it begins, a leaf where it ends. So the parts of a node that lies in several shards are just added up.
"""

import hashlib

from pyspark.sql import Window, functions as F

from pagelens.session import shared_folder

TURN = 16  # Bytes of a turn's digest.
WIDTH = 64  # Turns in a matrix; what is still shared behind them goes on in the next one.
CHUNK = 512  # Conversation ids in a piece of a list that goes over several shards.
NODE, PART, RUN, IDS = range(4)
SCHEMA = ("kind int, shard int, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
          "ends_sha256 string, key string, parent_key string, place long, last_depth long, ids string")
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversations(turns, id_column="conv_id", turn_column="turn", role_column="role", text_column="text"):
    """Every conversation with its turns in order: conv_id, steps (array of turn, digest, chars).

    Turns are ordered by number, NULL first, equal numbers by digest; repeated rows stay repeated turns. NULL
    roles and texts are empty. Rows without a conversation id belong to no conversation and are left out.
    Texts are hashed before anything is shuffled; a conversation is then about 30 bytes a turn in one row.
    """
    role, text = (F.coalesce(turns[c].cast("string"), F.lit("")) for c in (role_column, text_column))
    digest = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    step = F.struct(turns[turn_column].cast("long").alias("turn"), digest.alias("digest"), F.char_length(text).alias("chars"))
    rows = turns.select(turns[id_column].cast("long").alias("conv_id"), step.alias("step")).filter("conv_id IS NOT NULL")
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("step")).alias("steps"))


def with_shared_beginnings(convs, group=100, most=6):
    """Conversations whose first h turns are those of the first conversation of their hundred: h is the crc32 of the
    decimal id modulo ``most``, and their own turns after the first h follow. A first conversation that is shorter
    gives all it has, one that does not exist nothing; the result may have no turns."""
    base = F.col("conv_id") - F.col("conv_id") % group
    first = convs.filter(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.slice("steps", 1, most - 1).alias("shared"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    rows = convs.withColumn("base", base).join(first, "base", "left").withColumn("h", h)
    steps = F.concat(F.slice(F.coalesce("shared", F.slice("steps", 1, 0)), F.lit(1), F.col("h")), F.slice("steps", F.col("h") + 1, F.size("steps")))
    return rows.select("conv_id", steps.alias("steps"))


def common_turns(a, b):
    """How many whole turns two paths have in common; 0 if one of them is None."""
    if a is None or b is None:
        return 0
    low, high = 0, min(len(a), len(b)) // TURN
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle * TURN] == b[:middle * TURN] else (low, middle - 1)
    return low


def turn_numbers(paths):
    """The turns of all paths as numbers from 1 that keep the order of their digests."""
    import numpy as np
    high, low = np.frombuffer(b"".join(paths), ">u8").astype("u8").reshape(-1, 2).T
    order = np.lexsort((low, high))
    new = np.ones(len(order), "int32")
    new[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
    numbers = np.empty(len(order), "int32")
    numbers[order] = np.cumsum(new)
    return numbers


def levels(conv, lengths, numbers, chars, before, after, width=WIDTH):
    """The nodes of a shard, one dictionary of arrays for each depth, and the runs: row, first and last depth of turns
    that no other conversation shares.

    Rows are sorted as a matrix of turn numbers, padded with 0; a column in which a row differs from the one
    above, or an earlier column did, begins a node. Behind ``width`` turns only rows go on whose beginning is
    shared, in this shard or (for the first ``before`` turns of the first path and ``after`` of the last) with others.
    """
    import numpy as np
    firsts = np.cumsum(lengths) - lengths
    order = np.argsort(conv, kind="stable")
    ended = order[lengths[order] == 0]
    found = [{"n": np.array([len(conv)]), "conv": np.array([conv.min()]), "chars": np.zeros(1, "int64"), "parent": np.zeros(1, "int64"),
              "ended_node": np.zeros(len(ended), "int64"), "ended_row": ended, "runs": np.zeros(1, "int64")}]
    runs = []
    rows, group = order[lengths[order] > 0], np.zeros(int((lengths > 0).sum()), "int64")
    base = 0
    while len(rows):
        columns = int(min(width, lengths[rows].max() - base))
        matrix = np.zeros((len(rows), columns), "int32")
        sizes = np.minimum(lengths[rows] - base, columns)
        at = np.repeat(np.arange(len(rows)), sizes)
        column = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        place = np.repeat(firsts[rows] + base, sizes) + column
        matrix[at, column] = numbers[place]
        order = np.lexsort((conv[rows], *matrix.T[::-1], group))
        rows, group, matrix = rows[order], group[order], matrix[order]
        mask = np.ones(matrix.shape, bool)
        mask[1:] = (matrix[1:] != matrix[:-1]) | (group[1:] != group[:-1])[:, None]
        np.logical_or.accumulate(mask, axis=1, out=mask)
        above = group
        for j in range(columns):
            depth = base + j + 1
            inside = np.flatnonzero(matrix[:, j])
            begins = np.flatnonzero(mask[inside, j])
            node = np.cumsum(mask[inside, j]) - 1
            end = lengths[rows[inside]] == depth
            found.append({"n": np.add.reduceat(np.ones(len(inside), "int64"), begins), "conv": np.minimum.reduceat(conv[rows[inside]], begins),
                          "chars": chars[firsts[rows[inside[begins]]] + depth - 1], "parent": above[inside[begins]],
                          "ended_node": node[end], "ended_row": rows[inside[end]], "runs": np.zeros(len(begins), "int64")})
            above = np.full(len(rows), -1)
            above[inside] = node
        base += columns
        last = found[-1]
        shared = last["n"] > 1
        if base <= before:
            shared[0] = True
        if base <= after:
            shared[-1] = True
        going = np.flatnonzero(lengths[rows] > base)
        alone = going[~shared[above[going]]]
        runs += [(int(r), base + 1, int(lengths[r])) for r in rows[alone]]
        last["runs"] += np.bincount(above[alone], minlength=len(last["n"]))
        going = going[shared[above[going]]]
        rows, group = rows[going], above[going]
    return found, runs


def shard_nodes(shard, conv, paths, chars, before, after, width=WIDTH):
    """The rows of SCHEMA for one shard, as columns: its nodes, its parts of nodes that go on in other shards, the
    ids of the latter's conversations, and the runs. ``before`` and ``after`` are the neighbouring paths, or None."""
    import numpy as np
    lengths = np.array([len(p) // TURN for p in paths], "int64")
    first, last = min(paths), max(paths)
    shared_before, shared_after = common_turns(before, first), common_turns(last, after)
    found, runs = levels(conv, lengths, turn_numbers(paths), chars, shared_before, shared_after, width)

    for depth in range(len(found) - 1, -1, -1):  # From the deepest nodes up: what they add to their parents.
        level = found[depth]
        size = len(level["n"])
        level["begun"], level["open"], level["ending"] = np.ones(size, bool), np.zeros(size, bool), np.ones(size, bool)
        if before is not None and depth <= shared_before:
            level["begun"][0], level["open"][0] = False, True
        if after is not None and depth <= shared_after:
            level["ending"][-1], level["open"][-1] = False, True
        below = found[depth + 1] if depth + 1 < len(found) else {k: np.zeros(0, "int64") for k in ("parent", "begun", "leaves", "saved")}
        def added(values):
            total = np.zeros(size, "int64")
            np.add.at(total, below["parent"], values)
            return total
        children = added(np.ones(len(below["parent"]), "int64")) + level["runs"]
        level["children"] = added(below["begun"].astype("int64")) + level["runs"]
        level["leaves"] = added(below["leaves"]) + level["runs"] + ((children == 0) & level["ending"])
        level["saved"] = added(below["saved"]) + (level["n"] - level["begun"]) * level["chars"]

    def prefixes(path, most):
        state, keys = hashlib.sha256(), []
        for depth in range(most + 1):
            state.update(path[max(depth - 1, 0) * TURN:depth * TURN])
            keys.append(state.copy().hexdigest())
        return keys

    first_keys = prefixes(first, shared_before) if before is not None else []
    last_keys = prefixes(last, shared_after) if after is not None else []
    out = {name.split()[0]: [] for name in SCHEMA.split(", ")}

    def add(**columns):
        size = len(next(c for c in columns.values() if isinstance(c, (list, np.ndarray))))
        for name, values in out.items():
            value = columns.get(name)
            values.extend(value if isinstance(value, list) else value.tolist() if isinstance(value, np.ndarray) else [value] * size)

    nothing, keys_above, convs_above = hashlib.sha256(b"").hexdigest(), [None], np.zeros(1, "int64")
    for depth, level in enumerate(found):
        size = len(level["n"])
        keys = [None] * size
        if depth < len(first_keys):
            keys[0] = first_keys[depth]
        if depth < len(last_keys):
            keys[-1] = last_keys[depth]
        ends, pieces = [nothing] * size, []
        if len(level["ended_row"]):
            cuts = np.flatnonzero(np.diff(level["ended_node"])) + 1
            for ids, node in zip(np.split(conv[level["ended_row"]], cuts), level["ended_node"][np.concatenate([[0], cuts])]):
                if keys[node] is None:
                    ends[node] = hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()
                else:
                    pieces += [(keys[node], at, ",".join(map(str, ids[at:at + CHUNK].tolist()))) for at in range(0, len(ids), CHUNK)]
        parent_keys = [keys_above[p] for p in level["parent"].tolist()] if depth else [None] * size
        parents = [None if k is not None or not depth else c for k, c in zip(parent_keys, convs_above[level["parent"]].tolist())]
        add(kind=[NODE if k is None else PART for k in keys], shard=shard, depth=depth, conv_id=level["conv"], parent_conv_id=parents, n_convs=level["n"],
            n_children=level["children"], n_leaves=level["leaves"], saved_tokens=level["saved"], ends_sha256=ends, key=keys, parent_key=parent_keys)
        if pieces:
            add(kind=IDS, shard=shard, key=[p[0] for p in pieces], place=[p[1] for p in pieces], ids=[p[2] for p in pieces])
        keys_above, convs_above = keys, level["conv"]
    if runs:
        add(kind=RUN, shard=shard, conv_id=[int(conv[r]) for r, _, _ in runs], depth=[a for _, a, _ in runs], last_depth=[b for _, _, b in runs])
    return out


def joined_digests(pieces):
    """The SHA-256 of the comma-joined ids of each key; pieces are read one after the other, so a list of any length
    needs no more memory than a batch."""
    def run(batches):
        import pyarrow as pa
        current, state = None, None
        for batch in batches:
            done = []
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != current:
                    if state is not None:
                        done.append((current, state.hexdigest()))
                    current, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.string()) for i in (0, 1)], ["key", "ends"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.string()) for x in (current, state.hexdigest())], ["key", "ends"])

    ordered = pieces.repartition("key").sortWithinPartitions("key", "shard", "place").select("key", "ids")
    return ordered.mapInArrow(run, "key string, ends string")


def prefix_trie(convs, shard_turns=200_000, width=WIDTH):
    """The nodes of the trie of conversations (conv_id, steps as in ``conversations``): the columns RESULT.

    A node is a distinct sequence of the first d turns, from the root (d = 0, no turns) on; its members are the
    conversations that begin with it, also those without turns. conv_id is the smallest member, parent_conv_id that
    of the parent (root: NULL), n_convs the members, n_children the children, n_leaves the childless nodes in the subtree with
    its top, saved_tokens the sum over the subtree of (n_convs - 1) times the code points of the node's last text, and
    ends_sha256 the digest of the ids of members that end here, ascending, joined by commas. conv_id must be unique and
    not NULL; without conversations there is no node.

    A shard has about ``shard_turns`` turns, or as many as give every shuffle partition one, and is sorted in one task;
    equal conversations spread over shards by their ids. The nodes of several shards lie on the shards' first and
    last paths; their parts are summed, and the ids that end in them are hashed in order, piece by piece. Turns that no
    other conversation shares are a run, one row until the end.
    """
    spark = convs.sparkSession
    source, folder, nodes = (shared_folder(spark, f"trie-{name}-") for name in ("paths", "shards", "nodes"))
    path = F.unhex(F.array_join(F.transform("steps", lambda s: F.hex(s["digest"])), ""))
    convs.select("conv_id", path.alias("path"), F.transform("steps", lambda s: s["chars"]).alias("chars")).write.parquet(source)
    paths = spark.read.parquet(source)
    turns = paths.agg(F.sum(F.octet_length("path"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // (TURN * shard_turns)))
    ranged = paths.repartitionByRange(shards, "path", "conv_id")
    ranged.select(F.spark_partition_id().alias("shard"), "conv_id", "path", "chars").write.parquet(folder)
    ranged = spark.read.parquet(folder)

    in_order = Window.orderBy("shard")  # One row for each shard.
    limits = ranged.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last")).select(
        "shard", F.lag("last").over(in_order).alias("before"), F.lead("first").over(in_order).alias("after"))

    def build(rows, limit):
        import numpy as np
        import pyarrow as pa
        shard, before, after = (limit.column(c)[0].as_py() for c in ("shard", "before", "after"))
        chars = rows.column("chars").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype("int64")
        conv = np.array(rows.column("conv_id").to_pylist(), "int64")
        out = shard_nodes(shard, conv, rows.column("path").to_pylist(), chars, before, after, width)
        kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
        return pa.table({c.split()[0]: pa.array(out[c.split()[0]], kinds[c.split()[1]]) for c in SCHEMA.split(", ")})

    ranged.groupBy("shard").cogroup(limits.groupBy("shard")).applyInArrow(build, SCHEMA).write.parquet(nodes)
    found = spark.read.parquet(nodes)
    known = found.filter((F.col("kind") == NODE) & F.col("parent_key").isNull()).select(*RESULT)

    parts = found.filter(F.col("kind") == PART)
    whole = parts.groupBy("key").agg(F.min("depth").alias("depth"), F.min("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), *[
        F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    digests = joined_digests(found.filter(F.col("kind") == IDS))
    whole = whole.join(digests, "key", "left").withColumn("ends_sha256", F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256)))
    parents = whole.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    split = whole.join(parents, "parent_key", "left").select(*RESULT)

    # A shard meets its own parts only, so a parent with very many children brings no more than a shard to a task.
    by_shard = parts.select("shard", F.col("key").alias("parent_key")).distinct().join(parents, "parent_key")
    below = found.filter((F.col("kind") == NODE) & F.col("parent_key").isNotNull()).drop("parent_conv_id")
    below = below.join(by_shard, ["shard", "parent_key"]).select(*RESULT)

    run = found.filter(F.col("kind") == RUN).select("conv_id", "last_depth", F.explode(F.sequence("depth", "last_depth")).alias("depth"))
    last = F.col("depth") == F.col("last_depth")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    alone = run.select("conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), one.alias("n_convs"), F.when(last, none).otherwise(one).alias("n_children"),
                       one.alias("n_leaves"), none.alias("saved_tokens"), F.sha2(F.when(last, F.col("conv_id").cast("string")).otherwise("").cast("binary"), 256).alias("ends_sha256"))
    return known.unionByName(split).unionByName(below).unionByName(alone)
