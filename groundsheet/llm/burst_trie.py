"""Tries of conversation prefixes: suffix containers under trie heads, burst by their next turn, sorted and swept into nodes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundsheet.llm.mixing import word_count
from groundsheet.operators.lineage import materialize

#: Bytes of a turn's id, the first ones of a SHA-256 of role and text.
ID_BYTES = 16
#: A container with more suffixes is burst.  It bounds what a task holds; nodes do not depend on it.
CONTAINER = 256
#: Turns after which a conversation goes on under a head of its own, so that no row holds a long one.
SEGMENT = 64
#: Conversations whose number is divisible by this lend their first turns to those up to the next.
FAMILY = 20
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
_NODES = pa.schema([(c, pa.string() if c == "ends_sha256" else pa.int64()) for c in NODE])
_TOTALS = pa.schema([("head", pa.binary()), ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64())])


def _digest(*parts: Column) -> Column:
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 2 * ID_BYTES))


def _first() -> Column:
    return F.substring("tids", 1, ID_BYTES)


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), id (hex) and words of every turn, by turn (null first), ties by id."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * ID_BYTES)
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), named.alias("id"), word_count(text).cast("int").alias("words")
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "id")
    return turns.select("conv_id", (F.row_number().over(order) - 1).alias("pos"), "id", "words")


def segments(turns: DataFrame, family: int, segment: int) -> DataFrame:
    """conv_id, seg, tids and words of every rebuilt conversation, ``segment`` turns a row; a turnless one has an empty row.

    A conversation starts with up to three turns of its family's first, then its own turns after as
    many as its number's crc32 asks for.  The remainder of a negative number is negative, as in SQL.
    """
    turns = materialize(turns, "turns")
    lent = turns.where((F.col("conv_id") % family == 0) & (F.col("pos") < 3)).groupBy(F.col("conv_id").alias("family"))
    lent = lent.agg(F.sort_array(F.collect_list(F.struct("pos", "id", "words"))).alias("lent"))
    rows = turns.withColumn("family", F.col("conv_id") - F.col("conv_id") % family).join(lent, "family", "left")
    rows = rows.withColumn("asked", (F.crc32(F.col("conv_id").cast("string")) % 4).cast("int"))
    nothing = F.lit([]).cast("array<struct<pos:int,id:string,words:int>>")
    rows = rows.withColumn("lent", F.slice(F.coalesce("lent", nothing), F.lit(1), F.col("asked")))
    own = F.struct((F.col("pos") - F.col("asked") + F.size("lent")).alias("pos"), "id", "words")
    none = F.struct(F.lit(0).alias("pos"), F.lit(None).cast("string").alias("id"), F.lit(0).alias("words"))
    told = F.concat(
        F.when(F.col("pos") >= F.col("asked"), F.array(own)).otherwise(nothing),
        F.when(F.col("pos") == 0, F.concat("lent", F.array(none))).otherwise(nothing),  # the null id keeps turnless ones
    )
    told = rows.select("conv_id", F.inline(told)).withColumn("seg", F.floor(F.col("pos") / segment))
    listed = told.groupBy("conv_id", "seg").agg(
        F.sort_array(F.collect_list(F.when(F.col("id").isNotNull(), F.struct("pos", "id", "words")))).alias("turns")
    )
    tids = F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), ""))
    found = listed.select("conv_id", "seg", tids.alias("tids"), F.transform("turns", lambda t: t["words"]).alias("words"))
    return materialize(found, "segments")


def _chained(rows: DataFrame, segment: int) -> DataFrame:
    """Segments with head, the digest of all turns before them (empty at the start), and whether the conversation ends there.

    Conversations of one segment need no look; the others are read in order, one row at a time.
    """
    long = (F.col("seg") > 0) | (F.length("tids") == segment * ID_BYTES)
    alone = rows.where(~long).select("conv_id", "seg", "tids", "words", F.lit(b"").alias("head"), F.lit(True).alias("ends"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, head = None, b""
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if held is not None:
                    goes_on = held["conv_id"] == row["conv_id"]
                    found.append(held | {"head": head, "ends": not goes_on})
                    head = hashlib.sha256(head + held["tids"]).digest()[:ID_BYTES] if goes_on else b""
                held = row
            if found:
                yield pa.RecordBatch.from_pylist(found, schema=kinds)
        if held is not None:
            yield pa.RecordBatch.from_pylist([held | {"head": head, "ends": True}], schema=kinds)

    kinds = pa.schema([
        ("conv_id", pa.int64()), ("seg", pa.int64()), ("tids", pa.binary()), ("words", pa.list_(pa.int32())), ("head", pa.binary()), ("ends", pa.bool_()),
    ])
    chained = rows.where(long).repartition("conv_id").sortWithinPartitions("conv_id", "seg")
    return alone.union(chained.mapInArrow(run, "conv_id long, seg long, tids binary, words array<int>, head binary, ends boolean"))


def _end_digests(ends: DataFrame) -> DataFrame:
    """key and sha256 of the conv_ids that end there, in order; a key's ids stream through one hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, running = None, None
        for batch in batches:
            keys, shas = [], []
            for k, conv in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if k == key:
                    running.update(b",%d" % conv)
                    continue
                if running is not None:
                    keys.append(key)
                    shas.append(running.hexdigest())
                key, running = k, hashlib.sha256(b"%d" % conv)
            if keys:
                yield pa.RecordBatch.from_pydict({"key": keys, "sha": shas}, schema=kinds)
        if running is not None:
            yield pa.RecordBatch.from_pydict({"key": [key], "sha": [running.hexdigest()]}, schema=kinds)

    kinds = pa.schema([("key", pa.binary()), ("sha", pa.string())])
    return ends.repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(run, "key binary, sha string")


def suffixes(rows: DataFrame) -> DataFrame:
    """One row per different segment under a head: copies are an entry with a count.

    ``link`` is the head under which longer conversations go on, ``sha`` the digest of those that end.
    """
    rows = materialize(rows, "chained")
    ended = F.when(F.col("ends"), F.col("conv_id"))
    found = rows.groupBy("head", "tids", "words").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("least"), F.max("seg").alias("seg"), F.count(ended).alias("n_end"), F.min(ended).alias("end_least")
    )
    found = materialize(found.withColumn("key", _digest(F.col("head"), F.col("tids"))), "suffixes")
    shared = found.where("n_end > 1").select("key")
    digests = _end_digests(rows.where("ends").select(_digest(F.col("head"), F.col("tids")).alias("key"), "conv_id").join(shared, "key", "left_semi"))
    alone = found.where("n_end <= 1").withColumn("sha", F.when(F.col("n_end") == 1, F.sha2(F.col("end_least").cast("string"), 256)))
    return alone.union(found.where("n_end > 1").join(digests, "key").select(*found.columns, "sha")).select(
        "head", "seg", "tids", "words", "n", "least", "sha", F.when(F.col("n_end") < F.col("n"), F.col("key")).alias("link")
    )


def burst(entries: DataFrame, container: int) -> DataFrame:
    """Entries whose containers (head and first turn) hold at most ``container`` suffixes each, and a stub for each new head.

    An oversized container becomes a head: its suffixes lose their first turn and are dealt out by
    the next one.  A round handles the suffixes of the last round only, and a suffix has at most
    SEGMENT turns, so rounds are few whatever the data.
    """
    settled = []
    while True:
        entries = materialize(entries, "containers")
        sized = entries.withColumn("first", _first()).where(F.length("tids") > ID_BYTES).groupBy("head", "depth", "head_least", "first").agg(
            F.count("*").alias("entries"), F.sum("n").alias("n"), F.min("least").alias("least"), F.min(F.col("words")[0]).alias("word")
        )
        big = materialize(sized.where(F.col("entries") > container).withColumn("new", _digest(F.col("head"), F.col("first"))), "oversized")
        if big.isEmpty():
            return _union([*settled, entries])
        stubs = big.select(
            "head", "depth", "head_least", F.col("first").alias("tids"), F.array("word").alias("words"), "n", "least",
            F.lit(None).cast("string").alias("sha"), F.col("new").alias("link"),
        )
        marks = big.select(F.col("head").alias("h"), F.col("first").alias("f"), "new")
        met = (F.col("head") == F.col("h")) & (_first() == F.col("f")) & (F.length("tids") > ID_BYTES)
        settled += [entries.join(marks, met, "left_anti"), stubs]
        # What a suffix's container holds beside it: the smallest member is also that of entries that end with the first turn.
        ending = entries.where(F.length("tids") == ID_BYTES).select("head", F.col("tids").alias("first"), F.col("least").alias("shorter"))
        whole = big.join(ending, ["head", "first"], "left").select(
            F.col("head").alias("h"), F.col("first").alias("f"), "new", F.least("least", "shorter").alias("new_least")
        )
        entries = entries.join(whole, met).select(
            F.col("new").alias("head"), (F.col("depth") + 1).alias("depth"), F.col("new_least").alias("head_least"),
            F.expr(f"substring(tids, {ID_BYTES + 1})").alias("tids"), F.expr("slice(words, 2, size(words))").alias("words"), "n", "least", "sha", "link",
        )


def _union(frames: list[DataFrame]) -> DataFrame:
    found = frames[0]
    for f in frames[1:]:
        found = found.unionByName(f)
    return found


def _swept(rows: list[dict]) -> tuple[list[list], list]:
    """Nodes of one container, from its suffixes in order, and the totals it gives to its head: children, leaves, saved."""
    depth, out = rows[0]["depth"], []
    # an open node: turn, words, n, least, children, leaves, saved, sha, linked, places of its children
    top = [None, 0, 0, None, 0, 0, 0, None, False, []]
    path = []

    def close() -> None:
        node = path.pop()
        _, word, n, least, children, leaves, saved, sha, linked, kids = node
        if not children and not linked:
            leaves = 1
        saved += (n - 1) * word
        for k in kids:
            out[k][2] = least
        over = path[-1] if path else top
        over[2] += n
        over[3] = least if over[3] is None else min(over[3], least)
        over[4] += 1
        over[5] += leaves
        over[6] += saved
        over[9].append(len(out))
        out.append([least, depth + len(path) + 1, None, n, children, leaves, saved, sha])

    for row in rows:
        tids = row["tids"]
        turns = [tids[k : k + ID_BYTES] for k in range(0, len(tids), ID_BYTES)]
        shared = 0
        while shared < min(len(path), len(turns)) and path[shared][0] == turns[shared]:
            shared += 1
        while len(path) > shared:
            close()
        for turn, word in zip(turns[shared:], row["words"][shared:], strict=True):
            path.append([turn, word, 0, None, 0, 0, 0, None, False, []])
        last = path[-1]
        last[2] += row["n"]
        last[3] = row["least"] if last[3] is None else min(last[3], row["least"])
        last[7] = row["sha"] or last[7]
        if row["link"] is not None:
            last[8] = True
            for place, name in ((4, "children"), (5, "leaves"), (6, "saved")):
                last[place] += row[name] or 0
    while path:
        close()
    for k in top[9]:
        out[k][2] = rows[0]["head_least"]
    return out, top[4:7]


def _sweep(entries: DataFrame, totals: bool) -> DataFrame:
    """Every container's nodes, or what it gives to its head.  A task holds one container at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at, out = [], None, []

        def finish() -> None:
            nodes, given = _swept(held)
            out.extend([[held[0]["head"], *given]] if totals else nodes)

        schema = _TOTALS if totals else _NODES
        for batch in batches:
            for row in batch.to_pylist():
                place = row["head"], row["tids"][:ID_BYTES]
                if place != at and held:
                    finish()
                    held = []
                at = place
                held.append(row)
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)
                out = []
        if held:
            finish()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)

    kinds = "head binary, children long, leaves long, saved long" if totals else ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'long'}" for c in NODE)
    dealt = entries.where(F.length("tids") > 0).withColumn("first", _first()).repartition("head", "first").drop("first")
    return dealt.sortWithinPartitions("head", "tids").mapInArrow(run, kinds)


def _below(entries: DataFrame) -> DataFrame:
    """head, children, leaves and saved of everything under each head but the root.

    Sums over a tree of heads by jumping pointers: after k rounds a head holds what lies up to 2^k heads below.
    """
    given = _sweep(_plain(entries), True).where(F.length("head") > 0)
    own = given.groupBy("head").agg(*(F.sum(c).alias(c) for c in ("children", "leaves", "saved")))
    up = entries.where("link is not null").select(F.col("link").alias("head"), F.when(F.length("head") > 0, F.col("head")).alias("up"))
    state = materialize(own.join(up, "head"), "heads")
    while not state.where("up is not null").isEmpty():
        lent = state.where("up is not null").groupBy("up").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        over = state.select(F.col("head").alias("up"), F.col("up").alias("next"))
        moved = state.where("up is not null").join(over, "up").select("head", "next").withColumnRenamed("head", "h")
        state = state.join(lent.withColumnRenamed("up", "o"), F.col("head") == F.col("o"), "left").join(moved, F.col("head") == F.col("h"), "left")
        state = materialize(state.select(
            "head", F.col("next").alias("up"), "children",
            (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"),
        ), "heads")
    return state.drop("up")


def _plain(entries: DataFrame) -> DataFrame:
    zero = F.lit(None).cast("long")
    return entries.select("*", zero.alias("children"), zero.alias("leaves"), zero.alias("saved"))


def prefix_trie(conversations: DataFrame, family: int = FAMILY, container: int = CONTAINER, segment: int = SEGMENT) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    A conversation is its turns by ``turn`` (null first), ties in the order of the turns' ids (hex
    SHA-256 of role length, colon, role and text); a null role or text counts as empty.  It is rebuilt
    as the docstring of ``segments`` says.  Each distinct sequence of first turns is a node; the
    root stands for none.  Rows with a null conv_id belong to no conversation and are left out;
    repeated rows are turns of their own; an empty table gives no rows.  Only ``conv_id``, ``turn``,
    ``role`` and ``text`` are read.

    Texts are read once and stand for 16 bytes from then on.  Copies of a conversation are one entry,
    a long one is cut into segments under heads of their own, and oversized containers are
    burst, so a task holds at most ``container`` suffixes of ``segment`` turns.  The ids of copies that end
    at one node go through one hash, in order and one at a time: a SHA-256 has no parallel form.
    """
    rows = _chained(segments(ordered_turns(conversations), family, segment), segment)
    entries = materialize(suffixes(rows), "entries")
    at_root = F.length("head") == 0
    all_ = entries.where(at_root).agg(F.sum("n").alias("n"), F.min("least").alias("least")).first()
    if all_.n is None:
        return entries.sparkSession.createDataFrame([], ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'long'}" for c in NODE))
    parents = entries.where("link is not null").select(F.col("link").alias("head"), F.col("least").alias("head_least"))
    placed = entries.where(at_root).withColumn("head_least", F.lit(all_.least)).unionByName(entries.where(~at_root).join(parents, "head"))
    columns = ["head", (F.col("seg") * segment).alias("depth"), "head_least", "tids", "words", "n", "least", "sha", "link"]
    held = burst(placed.select(*columns), container)
    linked = held.where("link is not null")
    if linked.isEmpty():
        told = _plain(held)
    else:
        held = materialize(held, "held")
        below = _below(held).withColumnRenamed("head", "link")
        told = _plain(held.where("link is null")).unionByName(held.where("link is not null").join(below, "link"))
    nodes = materialize(_sweep(told, False), "nodes")
    under = nodes.where("depth = 1").agg(F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")).first()
    turnless = entries.where(at_root & (F.length("tids") == 0)).select("sha").first()
    values = [all_.least, 0, None, all_.n, under.children, under.leaves or 1, under.saved or 0]
    root = entries.sparkSession.range(1).select(
        *(F.lit(v).cast("long").alias(c) for v, c in zip(values, NODE, strict=False)), F.lit(turnless and turnless.sha).cast("string").alias("ends_sha256")
    )
    return nodes.unionByName(root).withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))
