"""The trie of conversation prefixes, built by bursting.

Conversations become sequences of turn ids. A shard starts as one container of suffixes under its head; a container with too many
turns bursts: its head moves down to where its suffixes part, and each next turn id gets a container of its own. What is left fits
a task, is sorted, and one sweep over the sorted suffixes makes its nodes. What the sweep found of each container is then added up
from the deepest heads to the root.

Nothing is gathered by conversation or by group of copies. Turns are numbered by sorting all of them by range, so that a long
conversation spreads over tasks; its sequence is cut into pieces of ``PIECE`` turns. Each later piece belongs to a trie of its own, whose
key is a hash of all pieces before it, and the deeper tries hand their sums to the piece they hang from. Equal pieces under one
key are one suffix with a number of members before any container is made. The ids that end in a node are sorted by
range and packed in each task before one stream of them is hashed.

Turns are ordered by turn, null first; turns of one number by role, text, both as ids; a repeated turn counts again. Null role or
text is empty. Turns without a conversation id belong to no conversation. A table without conversations has no nodes. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.components import saved

WIDTH = 32  # letters of a turn id
PIECE = 1024  # turns of a piece
CONTAINER = 50_000  # turns of a container that one task sweeps
GROUP, BORROWED = 5, 9  # conversations that share a first one, and one more than the turns they take from it at most
PACKED = 1 << 16  # bytes of ids that are passed on at once
NO_ENDS = hashlib.sha256(b"").hexdigest()
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def numbered(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, id, size) with ``pos``, their place in the conversation from 1, and ``length``, the conversation's number of turns."""
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("id"), F.col("row")]
    rows = saved(turns.withColumn("row", F.monotonically_increasing_id()), "turns")
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "id", "size")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, k = TaskContext.get().partitionId(), object(), 0
        for batch in batches:
            places = []
            for conv in batch.column("conv_id").to_pylist():
                k = k + 1 if conv == last else 1
                last = conv
                places.append(k)
            columns = [*batch.columns, pa.array([part] * len(places), pa.int32()), pa.array(places, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "id", "size", "part", "k"])

    kind = turns.schema["conv_id"].dataType.simpleString()
    rows = saved(rows.mapInArrow(number, f"conv_id {kind}, id string, size bigint, part int, k bigint"), "numbered")
    parts = rows.groupBy("conv_id", "part").agg(F.max("k").alias("here"))
    whole = Window.partitionBy("conv_id")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumns({"ahead": F.coalesce(F.sum("here").over(before), F.lit(0)), "length": F.sum("here").over(whole)})
    full = rows.join(parts.drop("here"), ["conv_id", "part"])
    return saved(full.select("conv_id", "id", "size", (F.col("k") + F.col("ahead")).alias("pos"), "length"), "positions")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations' turns (conv_id, depth, id, size, total), and all conversations (conv_id, total)."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))
    label = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", label.alias("id"), F.octet_length(text).cast("long").alias("size")
    )
    rows = numbered(turns)
    convs = rows.where("pos = 1").select(
        "conv_id", "length", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("donor"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % BORROWED).alias("h"),
    )
    donors = convs.select(F.col("conv_id").alias("donor"), F.col("length").alias("there"))
    taken = F.least("h", F.coalesce("there", F.lit(0))).alias("taken")
    convs = convs.join(donors, "donor", "left").select("conv_id", "donor", "h", taken, "length")
    total = (F.col("taken") + F.greatest(F.lit(0), F.col("length") - F.col("h"))).alias("total")
    convs = saved(convs.select("conv_id", "donor", "h", "taken", total), "conversations")
    own = rows.drop("length").join(convs, "conv_id").where("pos > h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "id", "size", "total")
    first = rows.where(F.col("pos") < BORROWED).select(F.col("conv_id").alias("donor"), F.col("pos").alias("depth"), "id", "size")
    lent = convs.join(first, "donor").where("depth <= h").select("conv_id", "depth", "id", "size", "total")
    return own.union(lent), convs.select("conv_id", "total")


def pieces(rows: DataFrame, convs: DataFrame, piece: int) -> DataFrame:
    """Pieces of conversations: conv_id, seg (which), path (turn ids), sizes, last (whether it ends there), and a, b (hash of the pieces before)."""
    seg = F.floor((F.col("depth") - 1) / piece).cast("long").alias("seg")
    listed = F.array_sort(F.collect_list(F.struct("depth", "id", "size"))).alias("t")
    full = rows.groupBy("conv_id", "total", seg).agg(listed).select(
        "conv_id", "total", "seg", F.array_join("t.id", "").alias("path"), F.col("t.size").alias("sizes")
    )
    ended = convs.where(F.col("total") % piece == 0).select(
        "conv_id", "total", F.floor(F.col("total") / piece).cast("long").alias("seg"), F.lit("").alias("path"),
        F.array().cast("array<bigint>").alias("sizes"),
    )
    both = full.union(ended).withColumn("last", F.col("seg") == F.floor(F.col("total") / piece))
    both = saved(both.drop("total"), "pieces")
    zero = F.lit(0).cast("long")
    short = both.where("seg = 0 and last").withColumns({"a": zero, "b": zero})
    before = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    long = both.where("seg > 0 or not last")
    long = long.withColumns({c: F.coalesce(F.bit_xor(piece_hash(c)).over(before), zero) for c in "ab"})
    return short.unionByName(long)


def piece_hash(which: str) -> Column:
    return F.xxhash64(F.lit(which), "seg", "path")


def ends(ending: DataFrame) -> DataFrame:
    """For each ``place``, the hash of the sorted ids (conv_id) that end there."""
    order = ["place", "conv_id"]
    rows = ending.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, ids, size = None, [], 0
        out = []

        def close():
            if ids:
                out.append((place, ids[0], ",".join(map(str, ids))))

        for batch in batches:
            for p, c in zip(batch.column("place").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if p != place or size > PACKED:
                    close()
                    place, ids, size = p, [], 0
                ids.append(c)
                size += 20
            if out:
                yield table(out)
                out.clear()
        close()
        if out:
            yield table(out)

    def table(out: list[tuple]) -> pa.RecordBatch:
        places, firsts, texts = zip(*out, strict=True)
        return pa.RecordBatch.from_pydict({"place": list(places), "first": list(firsts), "ids": list(texts)})

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, h = None, None
        for batch in batches:
            done = []
            for p, text in zip(batch.column("place").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if p != place:
                    if h is not None:
                        done.append((place, h.hexdigest()))
                    place, h = p, hashlib.sha256(text.encode())
                else:
                    h.update(b"," + text.encode())
            if done:
                yield pa.RecordBatch.from_pydict({"place": [d[0] for d in done], "ends": [d[1] for d in done]})
        if h is not None:
            yield pa.RecordBatch.from_pydict({"place": [place], "ends": [h.hexdigest()]})

    kind = ending.schema["conv_id"].dataType.simpleString()
    packed = rows.mapInArrow(pack, f"place string, first {kind}, ids string")
    packed = packed.repartition("place").sortWithinPartitions("place", "first").select("place", "ids")
    return packed.mapInArrow(digest, "place string, ends string")


def suffixes(pieces_: DataFrame) -> DataFrame:
    """Distinct pieces under each key: seg, a, b, path, sizes, n (members), conv_id (the least), ends (hash of the ids that end there, or null)."""
    key = ["seg", "a", "b", "path"]
    place = F.md5(F.concat_ws(":", *key).cast("binary")).alias("place")
    found = pieces_.groupBy(*key).agg(F.first("sizes").alias("sizes"), F.count("*").alias("n"), F.min("conv_id").alias("conv_id"))
    done = ends(pieces_.where("last").select(place, "conv_id"))
    return found.withColumn("place", place).join(done, "place", "left").drop("place")


def burst(level: DataFrame, most: int) -> tuple[DataFrame, list[DataFrame]]:
    """Suffixes in their containers (``box``, ``at`` turns below the trie's top, under head ``up``), and the heads of each round of bursting.

    A head has box, up, at, ``to`` (the depth where its suffixes part) and sizes; the suffix that ends there stays a container of its own, with ``at`` null.
    """
    rows = level.withColumns({"box": F.col("trie"), "up": F.lit(None).cast("string"), "at": F.lit(0)})
    ready, heads = [], []
    while True:
        many = rows.where("at is not null").groupBy("box").agg(
            F.count("*").alias("items"), F.sum(F.size("sizes")).alias("turns"), F.min("path").alias("low"), F.max("path").alias("high"),
            F.min("up").alias("up"), F.min("at").alias("at"), F.min(F.struct("path", "sizes"))["sizes"].alias("sizes"),
        ).where(f"items > 1 and turns > {most}")
        ends_at = F.sequence(F.lit(0), (F.least(F.length("low"), F.length("high")) / WIDTH).cast("int"))
        equal = F.filter(ends_at, lambda i: F.substr("low", F.lit(1), i * WIDTH) == F.substr("high", F.lit(1), i * WIDTH))
        many = saved(many.select("box", "up", "at", (F.size(equal) - 1).alias("to"), "sizes"), "heads")
        if many.isEmpty():
            break
        heads.append(many)
        ready.append(rows.join(many, "box", "left_anti").select(rows.columns))
        over = rows.drop("up", "at").join(many.select(F.col("box"), "to"), "box")
        stops = F.length("path") == F.col("to") * WIDTH
        below = F.md5(F.concat("box", F.lit("/"), F.substr("path", F.lit(1), (F.col("to") + 1) * WIDTH)).cast("binary"))
        over = over.withColumns({
            "up": F.col("box"), "box": F.when(stops, F.concat("box", F.lit("."))).otherwise(below), "at": F.when(~stops, F.col("to") + 1),
        })
        rows = saved(over.select(rows.columns), "containers")
    for more in ready:
        rows = rows.unionByName(more)
    return rows, heads


SWEPT = {
    "box": "string", "up": "string", "top": "boolean", "conv_id": "bigint", "depth": "bigint", "parent_conv_id": "bigint", "n": "bigint",
    "children": "bigint", "leaves": "bigint", "saved": "bigint", "ends": "string",
}
ARROW = {"string": pa.string(), "boolean": pa.bool_(), "bigint": pa.int64()}


def nodes_of(at: int, items: list[tuple]) -> list[list]:
    """The nodes of a container, from its sorted suffixes: [depth, parent's place, conv_id, n, children, leaves, saved, ends].

    The first is the top one, at depth ``at``, with no parent here. An item is (path, sizes, n, conv_id, ends, children, leaves,
    saved), the last three of what hangs below its end.
    """
    nodes: list[list] = []
    own: list[int] = []  # bytes of each node's last text
    open_: list[int] = []  # places of the nodes on the way to the current suffix; the k-th has depth at + k
    before = None
    for path, sizes, n, conv_id, ended, children, leaves, saved_below in items:
        keep = at
        if before is not None:
            depth = min(len(path), len(before)) // WIDTH
            while keep < depth and path[keep * WIDTH : (keep + 1) * WIDTH] == before[keep * WIDTH : (keep + 1) * WIDTH]:
                keep += 1
            del open_[keep - at + 1 :]
        for place in open_:
            node = nodes[place]
            node[2], node[3] = min(node[2], conv_id), node[3] + n
        for depth in range(keep + 1 if before is not None else at, len(path) // WIDTH + 1):
            if open_:
                nodes[open_[-1]][4] += 1
            nodes.append([depth, open_[-1] if open_ else None, conv_id, n, 0, 0, 0, None])
            own.append(sizes[depth - 1] if depth else 0)
            open_.append(len(nodes) - 1)
        end = nodes[open_[-1]]
        end[4], end[5], end[6], end[7] = end[4] + children, end[5] + leaves, end[6] + saved_below, ended
        before = path
    for node, size in zip(reversed(nodes), reversed(own), strict=True):
        node[5] = node[5] or 1
        node[6] += (node[3] - 1) * size
        if node[1] is not None:
            nodes[node[1]][5] += node[5]
            nodes[node[1]][6] += node[6]
    return nodes


def sweep(containers: DataFrame) -> DataFrame:
    """The nodes of all containers; ``top`` marks the one at the head of each, whose parent is not known here."""
    columns = ["box", "up", "at", "path", "sizes", "n", "conv_id", "ends", "children", "leaves", "saved"]
    rows = containers.select(*columns).repartition("box").sortWithinPartitions("box", "path")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def made() -> pa.RecordBatch:
            box, up, at = key
            nodes = nodes_of(at if at is not None else len(held[0][0]) // WIDTH, held)
            rows = [
                (box, up, p is None, conv, depth, None if p is None else nodes[p][2], n, *rest) for depth, p, conv, n, *rest in nodes
            ]
            columns = zip(SWEPT.items(), zip(*rows, strict=True), strict=True)
            return pa.RecordBatch.from_pydict({name: pa.array(values, ARROW[kind]) for (name, kind), values in columns})

        for batch in batches:
            for *k, path, sizes, n, conv_id, ended, children, leaves, saved_below in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != key:
                    if held:
                        yield made()
                    key, held = k, []
                held.append((path, sizes, n, conv_id, ended, children, leaves, saved_below))
        if held:
            yield made()

    return rows.mapInArrow(scan, ", ".join(f"{name} {kind}" for name, kind in SWEPT.items()))


def add_up(swept: DataFrame, heads: list[DataFrame]) -> tuple[list[DataFrame], DataFrame]:
    """All nodes below the tries' tops, and those tops, from what the sweep found and the heads, deepest first."""
    stats = ["conv_id", "n", "children", "leaves", "saved", "ends"]
    node = ["trie_top", "conv_id", "depth", "parent_conv_id", "n", "children", "leaves", "saved", "ends"]
    found = [swept.where("not top").withColumn("trie_top", F.lit(False)).select(node)]
    tops = swept.where("top").select("box", "up", "depth", *stats)
    for round_ in reversed(heads):
        here = round_.select(F.col("box").alias("up"), F.lit(True).alias("_here"))
        mine = tops.join(here, "up", "left")
        tops, kids = mine.where("_here is null").select("box", "up", "depth", *stats), mine.where("_here").drop("_here")
        is_end = F.col("box") == F.concat("up", F.lit("."))
        sums = kids.groupBy("up").agg(
            F.min("conv_id").alias("conv_id"), F.sum("n").alias("n"),
            F.sum(F.when(is_end, F.col("children")).otherwise(1)).alias("children"),
            F.sum(F.when(is_end & (F.col("children") == 0), 0).otherwise(F.col("leaves"))).alias("leaves"),
            F.sum(F.when(~is_end, F.col("saved")).otherwise(0)).alias("below"),
            F.max(F.when(is_end, F.col("ends"))).alias("ends"),
        )
        sums = saved(sums, "head-sums")
        parents = sums.select("up", F.col("conv_id").alias("parent_conv_id"))
        found.append(kids.where(~is_end).join(parents, "up").withColumn("trie_top", F.lit(False)).select(node))
        chain = round_.join(sums.withColumnRenamed("up", "box"), "box").withColumn("depth", F.explode(F.sequence("at", "to")))
        way = F.slice("sizes", F.greatest("depth", F.lit(1)), F.col("to") - F.greatest("depth", F.lit(1)) + 1)
        bytes_ = F.when(F.col("to") > 0, F.aggregate(way, F.lit(0).cast("long"), lambda s, x: s + x)).otherwise(F.lit(0).cast("long"))
        is_last = F.col("depth") == F.col("to")
        chain = chain.select(
            "box", "up", F.col("at").alias("_at"), F.col("depth").cast("long").alias("depth"), "conv_id", "n",
            F.when(is_last, F.col("children")).otherwise(1).alias("children"), "leaves",
            ((F.col("n") - 1) * bytes_ + F.col("below")).alias("saved"), F.when(is_last, F.col("ends")).alias("ends"),
        )
        chain = saved(chain, "head-nodes")
        inner = chain.where("depth > _at").withColumns({"parent_conv_id": F.col("conv_id"), "trie_top": F.lit(False)})
        found.append(inner.select(node))
        tops = tops.unionByName(chain.where("depth = _at").drop("_at"))
    return found, tops


def trie(conversations: DataFrame, most: int = CONTAINER, piece: int = PIECE) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: the columns ``NODE``."""
    items = saved(suffixes(pieces(*rebuilt(conversations), piece)), "suffixes")
    deepest = items.agg(F.max("seg")).first()[0]
    zero = F.lit(0).cast("long")
    nodes, below = [], None
    for seg in range(-1 if deepest is None else deepest, -1, -1):
        level = items.where(F.col("seg") == seg)
        hashes = {c: F.col(c).bitwiseXOR(piece_hash(c)) for c in "ab"}
        if below is None:
            level = level.withColumns({"children": zero, "leaves": zero, "saved": zero})
        else:
            level = level.withColumns({f"_{c}": h for c, h in hashes.items()})
            level = level.join(below, ["_a", "_b"], "left").withColumns({c: F.coalesce(c, zero) for c in ("children", "leaves", "saved")})
            level = level.withColumn("ends", F.coalesce("ends", "below_ends"))
        level = level.withColumn("trie", F.concat_ws(":", "a", "b"))
        level = saved(level.select("trie", "path", "sizes", "n", "conv_id", "ends", "children", "leaves", "saved"), "level")
        boxes, heads = burst(level, most)
        found, tops = add_up(saved(sweep(boxes), "swept"), heads)
        for more in found:
            nodes.append(more.withColumn("depth", F.col("depth") + seg * piece))
        if seg == 0:
            nodes.append(tops.select(F.lit(True).alias("trie_top"), "conv_id", "depth", F.lit(None).cast("long").alias("parent_conv_id"), "n", "children", "leaves", "saved", "ends"))
        else:
            key = F.split("box", ":")
            below = tops.select(
                key[0].cast("long").alias("_a"), key[1].cast("long").alias("_b"), "children",
                F.when(F.col("children") > 0, F.col("leaves")).otherwise(0).alias("leaves"), "saved", F.col("ends").alias("below_ends"),
            )
            below = saved(below, "tops")
    if not nodes:
        return conversations.sparkSession.createDataFrame([], ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'bigint'}" for c in NODE))
    rows = nodes[0]
    for more in nodes[1:]:
        rows = rows.unionByName(more)
    return rows.select(
        "conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
