"""The prefix trie of rebuilt conversations, measured along its Euler tour.

A conversation c starts with the first h turns of conversation c - c % 5 and goes on with its own turns after its first
h; h is crc32 of the decimal c, modulo 9.  A node is a distinct sequence of first turns (role, text).  It is named by
two polynomial sums over SHA-256 values of its turns modulo 2**61 - 1, and then by its smallest member and its depth.

Turns are placed by range over (conversation, turn), so one conversation may fill many tasks.  A task sums its stretch,
and what a range takes over from those before it is one small row per range.  Children of a parent are linked one to the
next: for a hot parent, which has more than one in `HOT` of all nodes, in shards that are then linked themselves.  Each
node gives an enter and an exit arc, the arcs form one list, and `euler_tour.rank_list` sums arcs, leaves and savings
along it.  What a subtree holds is the difference between its exit and its enter arc.

Rows without a conversation id belong to no conversation and are left out.  Null roles and texts are empty; null turns
come first; turns that tie go by role, then text, and repeated rows are turns of their own.  An empty table has no nodes,
not even a root.  Very long texts are read by Spark's own hash functions only.  Columns other than the four named are
not read, whatever they are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskrank.llm.euler_tour import BASE, rank_list
from riskrank.llm.frames import shuffle_width, text_bytes
from riskrank.session import cut_lineage

#: Turns that a conversation may take over from another: crc32 modulo one more than this.
HEAD = 8
#: A parent with more than one in this many nodes is hot; so many are at most broadcast.
HOT = 1024
#: Bytes of text in one range, on average, and rows of a conversation or ids of a node that are handled together.
RANGE_BYTES, BLOCK_BITS = 64 << 20, 12

# fixed values: the modulus, and a base for each of the two sums
_PRIME = (1 << 61) - 1
_BASES = (0x1B873593A5A5A5A5, 0x0E6546B64F1BBCDC)
#: What a sum over positions p becomes when the positions move by -HEAD..0.
_MOVE = [tuple(pow(b, -k, _PRIME) for b in _BASES) for k in range(HEAD + 1)]
_KEY = ["depth", "k1", "k2"]


def _local_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places and sums within the part of a conversation that lies in this range; `lead`: of its first one."""
    (b1, b2), part = _BASES, TaskContext.get().partitionId()
    conv, lead, n, s1, s2, p1, p2 = None, True, 0, 0, 0, 1, 1
    for batch in batches:
        out = []
        for c, v1, v2 in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if c != conv:
                lead = conv is None
                conv, n, s1, s2, p1, p2 = c, 0, 0, 0, 1, 1
            n, p1, p2 = n + 1, p1 * b1 % _PRIME, p2 * b2 % _PRIME
            t1, t2 = (s1 + v1 * p1) % _PRIME, (s2 + v2 * p2) % _PRIME
            out.append((n, t1, t2, s1, s2, lead))
            s1, s2 = t1, t2
        if out:
            p, t1, t2, r1, r2, leads = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), *(pa.array(x, pa.int64()) for x in (p, t1, t2, r1, r2)), batch.column("bytes"),
                 pa.array([part] * len(p), pa.int64()), pa.array(leads)],
                names=["conv", "p", "t1", "t2", "s1", "s2", "bytes", "part", "lead"])


def _taken_over(placed: DataFrame) -> dict[int, tuple[int, int, int]]:
    """What the first conversation of a range has in the ranges before: turns and sums.  One row per range."""
    row = F.struct("conv", "p", "t1", "t2")
    parts = placed.groupBy("part").agg(F.max(row).alias("last"), F.max(F.when(F.col("lead"), row)).alias("first"))
    out, held = {}, None
    for r in parts.orderBy("part").collect():
        conv, n, *sums = r["first"]
        if held and held[0] == conv:
            before = out[r["part"]] = held[1:]
            sums = [(t + pow(b, before[0], _PRIME) * s) % _PRIME for t, b, s in zip(before[1:], _BASES, sums)]
            n += before[0]
        held = (conv, n, *sums) if r["last"]["conv"] == conv else tuple(r["last"])
    return out


def turn_sums(turns: DataFrame, ranges: int) -> DataFrame:
    """(conv, p, t1, t2, s1, s2, bytes): place of each turn, and the sums over its conversation up to and before it."""
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    digest = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    value = [F.conv(F.substring(digest, at, 15), 16, 10).cast("long").alias(f"v{i}") for i, at in ((1, 1), (2, 16))]
    sorted_turns = turns.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select(
        "conv", *value, F.octet_length("text").cast("long").alias("bytes"))
    placed = cut_lineage(sorted_turns.mapInArrow(
        _local_sums, "conv long, p long, t1 long, t2 long, s1 long, s2 long, bytes long, part long, lead boolean"))
    before = _taken_over(placed)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.to_pydict()
            for i, (part, lead) in enumerate(zip(found["part"], found["lead"])):
                if lead and part in before:
                    n, *sums = before[part]
                    found["p"][i] += n
                    for b, base, own in zip(sums, _BASES, (("t1", "s1"), ("t2", "s2"))):
                        for name in own:
                            found[name][i] = (b + pow(base, n, _PRIME) * found[name][i]) % _PRIME
            yield pa.RecordBatch.from_pydict({k: found[k] for k in names}, schema=pa.schema(
                [(k, pa.int64()) for k in names]))

    names = ["conv", "p", "t1", "t2", "s1", "s2", "bytes"]
    return placed.mapInArrow(settle, ", ".join(f"{n} long" for n in names))


def rebuilt(sums: DataFrame) -> DataFrame:
    """(conv, depth, k1, k2, q1, q2, bytes, ends): each prefix of each rebuilt conversation, the empty one too.

    `k1, k2` name the prefix and `q1, q2` the one without its last turn; `ends` marks the whole conversation.
    """
    first = F.when(F.col("p") <= HEAD, F.struct("p", "t1", "t2", "s1", "s2", "bytes"))
    about = cut_lineage(sums.groupBy("conv").agg(
        F.max("p").alias("n"), F.sort_array(F.collect_list(first)).alias("head")))  # up to HEAD turns each
    taken = F.crc32(F.encode(F.col("conv").cast("string"), "UTF-8")) % (HEAD + 1)
    other = about.select(F.col("conv").alias("base"), F.col("n").alias("n_base"), F.col("head").alias("base_head"))
    plan = about.withColumn("h", taken).withColumn("base", F.col("conv") - F.col("conv") % 5).join(
        other, "base", "left").withColumn("m", F.least("h", F.coalesce("n_base", F.lit(0))))
    own, base = F.get("head", (F.col("h") - 1).cast("int")), F.get("base_head", (F.col("m") - 1).cast("int"))
    zero = F.lit(0).cast("long")
    plan = cut_lineage(plan.select(
        "conv", "n", "h", "m", F.slice(F.coalesce("base_head", F.array()), F.lit(1), F.col("m").cast("int")).alias("head"),
        (F.col("m") + F.greatest(F.col("n") - F.col("h"), zero)).alias("length"),
        *[F.coalesce(base[f"t{i}"], zero).alias(f"b{i}") for i in (1, 2)],
        *[F.coalesce(own[f"t{i}"], zero).alias(f"o{i}") for i in (1, 2)]))

    ends = F.col("depth") == F.col("length")
    shared = plan.select("conv", "length", F.explode("head").alias("x")).select(
        "conv", F.col("x.p").alias("depth"), F.col("x.t1").alias("k1"), F.col("x.t2").alias("k2"),
        F.col("x.s1").alias("q1"), F.col("x.s2").alias("q2"), "x.bytes", "length").withColumn("ends", ends)
    root = plan.select("conv", *[zero.alias(c) for c in _KEY], *[F.lit(None).cast("long").alias(c) for c in ("q1", "q2")],
                       zero.alias("bytes"), (F.col("length") == 0).alias("ends"))
    # a conversation of many turns meets its one row of `plan` in blocks
    block = F.shiftright("p", BLOCK_BITS)
    blocks = plan.filter(F.col("n") > F.col("h")).drop("head").withColumn(
        "block", F.explode(F.sequence(F.shiftright("h", BLOCK_BITS), F.shiftright("n", BLOCK_BITS))))
    rest = sums.withColumn("block", block).join(blocks, ["conv", "block"]).filter(F.col("p") > F.col("h")).select(
        "conv", (F.col("m") + F.col("p") - F.col("h")).alias("depth"), "t1", "t2", "s1", "s2", "bytes", "length",
        (F.col("h") - F.col("m")).alias("moved"), "b1", "b2", "o1", "o2").withColumn("ends", ends)

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.to_pydict()
            out = [[(b + _MOVE[k][i] * (s - o)) % _PRIME for b, k, s, o in zip(x[f"b{i + 1}"], x["moved"], x[name], x[f"o{i + 1}"])]
                   for i, name in ((0, "t1"), (1, "t2"), (0, "s1"), (1, "s2"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("depth"), *(pa.array(o, pa.int64()) for o in out), batch.column("bytes"),
                 batch.column("ends")], names=["conv", "depth", "k1", "k2", "q1", "q2", "bytes", "ends"])

    moved = rest.mapInArrow(rename, "conv long, depth long, k1 long, k2 long, q1 long, q2 long, bytes long, ends boolean")
    return moved.unionByName(shared.drop("length")).unionByName(root)


def end_digests(members: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256): SHA-256 of the ids of the conversations that end at a node, in order.

    Ids are joined in blocks of nearby ones, and the blocks of a node pass through one running hash in order.
    """
    ids = F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string"))  # one in a block is one number
    blocks = members.filter("ends").groupBy(*_KEY, F.shiftright("conv", BLOCK_BITS).alias("block")).agg(
        F.array_join(ids, ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, running = None, None
        for batch in batches:
            done = []
            for *k, ids in zip(*(batch.column(c).to_pylist() for c in (*_KEY, "ids"))):
                if k != key:
                    if key is not None:
                        done.append((*key, running.hexdigest()))
                    key, running = k, hashlib.sha256(ids.encode())
                else:
                    running.update(b"," + ids.encode())
            yield record(done)
        if key is not None:
            yield record([(*key, running.hexdigest())])

    def record(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                                          names=[*_KEY, "ends_sha256"])

    return blocks.repartition(*_KEY).sortWithinPartitions(*_KEY, "block").mapInArrow(
        digest, "depth long, k1 long, k2 long, ends_sha256 string")


def linked_nodes(members: DataFrame) -> DataFrame:
    """Nodes by smallest member (`conv_id`) and depth, with parent, first child, next sibling and their sizes."""
    # the parent's name is the same for all members
    nodes = cut_lineage(members.groupBy(*_KEY).agg(
        F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("q1").alias("q1"),
        F.max("q2").alias("q2"), F.max("bytes").alias("bytes")))
    up = ["up", "q1", "q2"]
    child = nodes.filter(F.col("depth") > 0).withColumn("up", F.col("depth") - 1)
    counts = cut_lineage(child.groupBy(*up).agg(F.count(F.lit(1)).alias("n_children")))
    total = counts.agg(F.sum("n_children").alias("n")).first()["n"] or 0
    hot = F.broadcast(cut_lineage(counts.filter(F.col("n_children") > total // HOT).select(  # fewer than HOT rows
        *up, F.lit(True).alias("hot"))))
    shard = F.when(F.col("hot"), F.pmod(F.xxhash64("k1", "k2"), F.lit(HOT))).otherwise(F.lit(0)).cast("long")
    child = child.join(hot, up, "left").withColumn("shard", shard)

    # the next sibling: within a shard, and from the last of a shard to the first of the next
    near = Window.partitionBy(*up, "shard").orderBy("conv_id")
    row = child.withColumn("next", F.lead("conv_id").over(near))
    shards = child.groupBy(*up, "shard").agg(F.min("conv_id").alias("first"))
    far = Window.partitionBy(*up).orderBy("shard")  # up to HOT rows of a parent
    over = shards.withColumn("after", F.lead("first").over(far)).filter(F.col("after").isNotNull()).select(
        *up, "shard", "after")
    last = row.filter(F.col("next").isNull() & F.col("hot")).join(over, [*up, "shard"], "left").withColumn(
        "next", F.col("after")).drop("after")
    child = row.filter(F.col("next").isNotNull() | F.col("hot").isNull()).unionByName(last)

    # a parent's first child is the first of its first shard
    firsts = shards.groupBy(*up).agg(F.min(F.struct("shard", "first"))["first"].alias("first_child"))
    parent = nodes.select(F.col("depth").alias("up"), F.col("k1").alias("q1"), F.col("k2").alias("q2"),
                          F.col("conv_id").alias("parent_conv_id"))
    below = parent.join(firsts, up).join(counts, up)
    below = cut_lineage(below)
    hot_parents = F.broadcast(below.join(hot, up).select(*up, F.col("parent_conv_id").alias("hot_parent")))
    # children of hot parents know theirs by broadcast, and carry keys that meet nothing in the join of the others
    with_hot = child.join(hot_parents, up, "left")
    key = F.when(F.col("hot_parent").isNull(), F.col("q1")).otherwise(-1 - F.col("k1"))
    children = with_hot.withColumn("key", key).join(
        below.select("up", F.col("q1").alias("key"), "q2", "parent_conv_id"), ["up", "key", "q2"], "left").select(
        *_KEY, F.coalesce("hot_parent", "parent_conv_id").alias("parent_conv_id"), F.col("next").alias("next_sibling"))
    return nodes.select(*_KEY, "conv_id", "n_convs", "bytes").join(children, _KEY, "left").join(
        below.select(F.col("up").alias("depth"), F.col("q1").alias("k1"), F.col("q2").alias("k2"), "first_child",
                     "n_children"), _KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))


def tour(nodes: DataFrame) -> DataFrame:
    """The Euler tour's arcs: enter (2 * depth) and exit (2 * depth + 1) of each node, and the arc after each."""
    down, level = F.col("first_child").isNotNull(), 2 * F.col("depth")
    enter = F.struct(
        level.alias("b"), F.coalesce("first_child", "conv_id").alias("na"),
        F.when(down, level + 2).otherwise(level + 1).alias("nb"), F.lit(1).cast("long").alias("arcs"),
        (~down).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    zero, beside = F.lit(0).cast("long"), F.col("next_sibling").isNotNull()
    leave = F.struct(
        (level + 1).alias("b"), F.coalesce("next_sibling", "parent_conv_id").alias("na"),
        F.when(beside, level).when(F.col("depth") > 0, level - 1).alias("nb"), F.lit(1).cast("long").alias("arcs"),
        zero.alias("leaves"), zero.alias("saved"))
    return nodes.select(F.col("conv_id").alias("a"), F.explode(F.array(enter, leave)).alias("x")).select("a", "x.*")


def prefix_trie(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text", base: int = BASE) -> DataFrame:
    """One row per node: its members, children, the leaves below it and the bytes its subtree saves.

    `enter_arc` and `exit_arc` are the positions of the node's arcs in the tour.
    """
    named = conversations.select(
        F.col(f"`{conv_id}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"),
        *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text"))])
    turns = named.filter(F.col("conv").isNotNull())
    ranges = max(shuffle_width(conversations), -(-text_bytes(turns)[1] // RANGE_BYTES))
    members = cut_lineage(rebuilt(cut_lineage(turn_sums(turns, ranges))))
    nodes = cut_lineage(linked_nodes(members))
    sums = rank_list(tour(nodes), ["arcs", "leaves", "saved"], base)
    enters = F.col("b") % 2 == 0
    spans = sums.groupBy(F.col("a").alias("conv_id"), F.shiftright("b", 1).alias("depth")).agg(
        *[(F.max(F.when(~enters, F.col(v))) - F.max(F.when(enters, F.col(v)))).alias(n)
          for v, n in (("leaves", "n_leaves"), ("saved", "saved_tokens"))],
        F.max(F.when(enters, F.col("arcs"))).alias("enter_arc"), F.max(F.when(~enters, F.col("arcs"))).alias("exit_arc"))
    found = nodes.join(end_digests(members), _KEY, "left").join(spans, ["conv_id", "depth"])
    nobody = hashlib.sha256(b"").hexdigest()
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", F.lit(nobody)).alias("ends_sha256"), "enter_arc", "exit_arc")
