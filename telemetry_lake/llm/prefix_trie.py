"""The trie of all prefixes of conversations.

Conversations are sorted by their turns; two neighbours share their longest common prefix
(LCP), and a node of the trie is a run of neighbours. Each range of the sorted order builds
its forest by union-find over the LCPs of neighbours in descending depth: a component is a
run, a merge at some depth makes the branching node there, and the nodes above a component
up to its merge form a chain. Only nodes on a common prefix of two neighbouring ranges reach
over a boundary. They are contracted to sums, merged by the range they begin in, and their
subtrees completed by running sums over the ranges. All other nodes are finished where they
are.

Turns are compared by SHA-256 of role and text. Equal conversations are one row, with the
number of copies, before anything is sorted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.llm.tables import shuffle_width, stored, table

#: Turns of distinct conversations a range has, about.
RANGE_TURNS = 1 << 20
_TURNS = "array<struct<digest:binary,words:bigint>>"


def turn_lists(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of every conversation in order, as digest and number of words.

    Order is by turn, null first, then role, then digest. Null roles and texts are empty. Rows
    without a conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    marked = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct(
            F.col("turn").isNotNull().alias("given"),
            F.col("turn").alias("turn"),
            role.alias("role"),
            F.unhex(F.sha2(marked, 256)).alias("digest"),
            words.alias("words"),
        ).alias("t"),
    )
    listed = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    turns = F.transform("t", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words")))
    return listed.select("conv_id", turns.alias("turns"))


def rebuilt(lists: DataFrame, stride: int = 20, heads: int = 4) -> DataFrame:
    """Every conversation c with its first h turns replaced by those of conversation c - c % stride,
    h being CRC-32 of c as text modulo ``heads``."""
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string")) % heads).cast("int")
    none = F.array().cast(_TURNS)
    bases = lists.where(c % stride == 0).select(
        c.alias("base"), F.slice("turns", 1, heads - 1).alias("head")
    )
    return (
        lists.withColumn("base", c - c % stride)
        .join(bases, "base", "left")
        .select(
            "conv_id",
            F.concat(
                F.slice(F.coalesce("head", none), F.lit(1), h),
                F.slice("turns", h + 1, F.size("turns")),
            ).alias("turns"),
        )
    )


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted conversations with the LCP to the one before; the digests only at both ends."""
    part, at, before, held = TaskContext.get().partitionId(), 0, None, None
    for batch in batches:
        rows = batch.to_pylist()
        sizes, lcps = [], []
        for row in rows:
            digests = row["digests"]
            lcp = -1
            if before is not None:
                lcp = 0
                for x, y in zip(before, digests, strict=False):
                    if x != y:
                        break
                    lcp += 1
            sizes.append(len(digests))
            lcps.append(lcp)
            before = digests
        ends = [r["digests"] if at + k == 0 else None for k, r in enumerate(rows)]
        out = pa.RecordBatch.from_arrays(
            [
                pa.array([part] * len(rows), pa.int32()),
                pa.array(range(at, at + len(rows)), pa.int64()),
                pa.array(sizes, pa.int64()),
                pa.array(lcps, pa.int64()),
                *(batch.column(c) for c in ("words", "copies", "conv", "key")),
                pa.array(ends, pa.list_(pa.binary())),
            ],
            ["part", "at", "size", "lcp", "words", "copies", "conv", "key", "ends"],
        )
        at += len(rows)
        if held is not None:
            yield held
        held = out
    if held is None:
        return
    # The last row is known only now.
    ends = held.column("ends").to_pylist()
    ends[-1] = before
    where = held.schema.get_field_index("ends")
    yield held.set_column(where, "ends", pa.array(ends, pa.list_(pa.binary())))


@dataclass
class Part:
    """The sorted conversations of a range."""

    size: np.ndarray
    lcp: np.ndarray
    copies: np.ndarray
    conv: np.ndarray
    words: np.ndarray  # of all turns, end to end
    keys: list

    def __post_init__(self) -> None:
        self.start = np.cumsum(self.size) - self.size
        self.sums = np.concatenate([[0], np.cumsum(self.words)])

    def words_to(self, row: np.ndarray | int, depth: np.ndarray | int) -> np.ndarray | int:
        """Words of the first turns of a row."""
        return self.sums[self.start[row] + depth] - self.sums[self.start[row]]


@dataclass
class Segments:
    """Chains of nodes with the same conversations: depths ``above`` + 1 to ``depth``."""

    row: list[int] = field(default_factory=list)
    above: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    shared: list[int] = field(default_factory=list)  # nodes up to here reach over a boundary
    copies: list[int] = field(default_factory=list)
    conv: list[int] = field(default_factory=list)
    kids: list[int] = field(default_factory=list)  # finished children of the deepest node
    leaves: list[int] = field(default_factory=list)  # finished leaves below it
    saved: list[int] = field(default_factory=list)  # finished savings below it
    parent: list[int] = field(default_factory=list)


def forest(part: Part, left: int, right: int) -> Segments:
    """Segments of a range by union-find in descending LCP. ``left`` and ``right``: LCP of its first
    row with the range before, of its last row with the range after; -1 where there is none."""
    m = len(part.size)
    out = Segments()
    root = list(range(m))
    low, high = list(range(m)), list(range(m))
    depth, copies, conv = part.size.tolist(), part.copies.tolist(), part.conv.tolist()
    kids, leaves, saved = [0] * m, [0] * m, [0] * m
    children: list[list[int]] = [[] for _ in range(m)]

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def close(c: int, above: int) -> None:
        """End the chain of a component; it then stands at depth ``above``."""
        if depth[c] <= above:
            return
        shared = max(left if low[c] == 0 else -1, right if high[c] == m - 1 else -1)
        out.row.append(low[c])
        out.above.append(above)
        out.depth.append(depth[c])
        out.shared.append(shared)
        out.copies.append(copies[c])
        out.conv.append(conv[c])
        out.kids.append(kids[c])
        out.leaves.append(leaves[c] if kids[c] else 1)
        out.saved.append(saved[c])
        out.parent.append(-1)
        me = len(out.row) - 1
        for child in children[c]:
            out.parent[child] = me
        if shared <= above:  # all of it is finished
            chain = int(part.words_to(low[c], depth[c]) - part.words_to(low[c], above))
            saved[c] += (copies[c] - 1) * chain
            leaves[c], kids[c] = out.leaves[-1], 1
        else:
            saved[c] = leaves[c] = kids[c] = 0
        children[c] = [me]
        depth[c] = above

    lcp = part.lcp.tolist()
    for i in sorted(range(1, m), key=lambda k: -lcp[k]):
        a, b = find(i - 1), find(i)
        close(a, lcp[i])
        close(b, lcp[i])
        if len(children[a]) < len(children[b]):
            keep, gone = b, a
        else:
            keep, gone = a, b
        low[keep], high[keep] = low[a], high[b]
        children[keep] += children[gone]
        children[gone] = []
        copies[keep] += copies[gone]
        conv[keep] = min(conv[keep], conv[gone])
        kids[keep] += kids[gone]
        leaves[keep] += leaves[gone]
        saved[keep] += saved[gone]
        root[gone] = keep
    if m:
        close(find(0), -1)
    return out


@dataclass
class Borders:
    """``shared[q]``: LCP of the last row of range q and the first of q + 1. ``inner[q]``: depth to which
    all rows of range q agree. ``numbers``: the ranges that have rows, as they were dealt."""

    numbers: list[int]
    shared: list[int]
    inner: list[int]

    def around(self, number: int) -> tuple[int, int]:
        left = self.shared[number - 1] if number > 0 else -1
        return left, self.shared[number] if number < len(self.shared) else -1

    def origins(self, number: int, depths: np.ndarray) -> np.ndarray:
        """The ranges in which the prefixes of a range's first row begin, by depth."""
        out = np.full(len(depths), number)
        least = self.around(number)[0]
        for q in range(number - 1, -1, -1):
            least = min(least, self.shared[q])
            reach = depths <= least
            if not reach.any():
                break
            out[reach] = q
            least = min(least, self.inner[q])
        return out


_NODE = (
    "part int, first_part int, depth bigint, conv_id bigint, parent_conv_id bigint, parent_part int, n_convs bigint,"
    " n_children bigint, n_leaves bigint, saved_tokens bigint, words bigint, key binary, finished boolean"
)


def node_rows(part: Part, number: int, borders: Borders) -> pa.RecordBatch:
    """Finished nodes of a range, and its share of the nodes that reach over a boundary."""
    left, right = borders.around(number)
    found = forest(part, left, right)
    s = {k: np.array(v, dtype=np.int64) for k, v in vars(found).items()}
    n = s["depth"] - s["above"]
    seg = np.repeat(np.arange(len(n)), n)
    depth = np.arange(len(seg)) - np.repeat(np.cumsum(n) - n, n) + s["above"][seg] + 1
    row, top = s["row"][seg], s["depth"][seg]
    open_here = depth <= s["shared"][seg]
    # What is finished hangs from the deepest shared node of a chain.
    hangs = np.minimum(s["shared"], s["depth"])[seg]
    below = np.maximum(np.where(open_here, hangs, depth - 1), 0)
    chain = (s["copies"][seg] - 1) * (part.words_to(row, top) - part.words_to(row, below))
    savings = s["saved"][seg] + chain
    kids = np.where(depth == top, s["kids"][seg], 1)
    leaves = s["leaves"][seg]
    holds = open_here & (depth == hangs)
    bare = open_here & (depth == top) & (s["kids"][seg] == 0)
    # A shared node counts what is finished below it; its own part follows when all is merged.
    kids = np.where(open_here & ~holds, 0, kids)
    leaves = np.where(open_here & (~holds | bare), 0, leaves)
    savings = np.where(open_here & ~holds, 0, savings)

    above = s["parent"][seg]
    same = depth - 1 > s["above"][seg]
    parent_conv = np.where(same, s["conv"][seg], s["conv"][np.maximum(above, 0)])
    parent_shared = np.where(same, s["shared"][seg], s["shared"][np.maximum(above, 0)]) >= depth - 1
    begins = np.full(len(seg), number)
    parent_part = begins.copy()
    if left >= 0:
        reach = np.arange(left + 1)
        origin = borders.origins(number, reach)
        mine = open_here & (row == 0) & (depth <= left)
        begins[mine] = origin[depth[mine]]
        up = parent_shared & (depth > 0) & (depth - 1 <= left)
        parent_row = np.where(same, row, s["row"][np.maximum(above, 0)])
        up &= parent_row == 0
        parent_part[up] = origin[depth[up] - 1]
    ends = part.size[row] == depth
    last = np.zeros(len(seg), dtype=np.int64)
    deep = depth > 0
    last[deep] = part.words[part.start[row[deep]] + depth[deep] - 1]
    finished = ~open_here
    known = finished & ~parent_shared & deep
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(seg), number), pa.int32()),
            pa.array(begins, pa.int32()),
            pa.array(depth),
            pa.array(s["conv"][seg]),
            pa.array(parent_conv, mask=~known),
            pa.array(parent_part, pa.int32(), mask=known | ~deep),
            pa.array(s["copies"][seg]),
            pa.array(kids),
            pa.array(leaves),
            pa.array(savings),
            pa.array(last),
            pa.array([part.keys[r] if e else None for r, e in zip(row.tolist(), ends.tolist(), strict=True)], pa.binary()),
            pa.array(finished),
        ],
        [x.split()[0] for x in _NODE.split(", ")],
    )


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Part]]:
    """Whole ranges from rows in order of range and place."""
    number, held = None, []

    def made() -> Part:
        whole = pa.Table.from_batches(held).combine_chunks()
        words = whole.column("words").combine_chunks()
        flat = words.values[words.offsets[0].as_py() : words.offsets[-1].as_py()] if len(words) else words.values
        return Part(
            *(whole.column(c).to_numpy() for c in ("size", "lcp", "copies", "conv")),
            flat.to_numpy(zero_copy_only=False),
            whole.column("key").to_pylist(),
        )

    for batch in batches:
        numbers = batch.column("number").to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(numbers)) + 1, [len(numbers)]])
        for x, y in zip(cuts, cuts[1:], strict=False):
            if x == y:
                continue
            if number is not None and numbers[x] != number:
                yield number, made()
                held = []
            number = int(numbers[x])
            held.append(batch.slice(x, y - x))
    if held:
        yield number, made()


def member_digests(members: DataFrame) -> DataFrame:
    """(key, ends_sha256): SHA-256 of the ids of each key, ascending, in decimal, comma-joined.

    The ids are sorted over all tasks and joined to texts there, so one key with very many ids
    is few rows to the task that hashes it, and is never held as a whole.
    """
    width = shuffle_width(members.sparkSession)

    def runs(batch: pa.RecordBatch) -> Iterator[tuple[bytes, int, int]]:
        keys = batch.column("key").to_pylist()
        begin = 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[begin]:
                yield keys[begin], begin, i
                begin = i

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("conv_id").to_numpy()
            out = [(k, int(ids[x]), ",".join(map(str, ids[x:y].tolist()))) for k, x, y in runs(batch)]
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.string()), strict=True)],
                ["key", "first", "ids"],
            )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def record(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in rows], pa.binary()), pa.array([h for _, h in rows], pa.string())],
                ["key", "ends_sha256"],
            )

        key, state = None, hashlib.sha256()
        for batch in batches:
            done = []
            for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if k != key:
                    if key is not None:
                        done.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256(ids.encode())
                else:
                    state.update(("," + ids).encode())
            yield record(done)
        if key is not None:
            yield record([(key, state.hexdigest())])

    texts = (
        members.select("key", "conv_id")
        .repartitionByRange(width, "key", "conv_id")
        .sortWithinPartitions("key", "conv_id")
        .mapInArrow(written, "key binary, first bigint, ids string")
    )
    ordered = texts.repartition(width, "key").sortWithinPartitions("key", "first")
    return ordered.mapInArrow(hashed, "key binary, ends_sha256 string")


def _borders(ranked: DataFrame) -> Borders:
    """A few numbers for each range."""
    ends = stored(
        ranked.groupBy("part").agg(
            F.min_by("ends", F.when(F.col("ends").isNotNull(), F.col("at"))).alias("head"),
            F.max_by("ends", F.when(F.col("ends").isNotNull(), F.col("at"))).alias("tail"),
            F.least(F.min(F.when(F.col("at") > 0, F.col("lcp"))), F.min("size")).alias("inner"),
        ),
        "trie-ends",
    )
    inner = {r.part: r.inner for r in ends.select("part", "inner").collect()}
    numbers = sorted(inner)
    spark = ranked.sparkSession
    order = spark.createDataFrame(list(zip(numbers, numbers[1:], strict=False)), "part int, next int")
    heads = ends.select(F.col("part").alias("next"), "head")
    same = F.zip_with("tail", "head", lambda x, y: x.eqNullSafe(y))
    wrong = F.array_position(same, False)
    depth = F.when(wrong == 0, F.size(same)).otherwise(wrong - 1)
    pairs = order.join(ends.select("part", "tail"), "part").join(heads, "next")
    found = {r.part: r.depth for r in pairs.select("part", depth.cast("bigint").alias("depth")).collect()}
    return Borders(numbers, [found[p] for p in numbers[:-1]], [inner[p] for p in numbers])


def trie(lists: DataFrame, ranges: int | None = None) -> DataFrame:
    """One row per node of the trie of (conv_id, turns) rows.

    conv_id (the smallest member), depth, parent_conv_id (null for the root), n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256. Every conversation is a member of the root,
    also one without turns. No rows, no nodes. The digests of one conversation are one row
    (40 bytes a turn); ids must not repeat.
    """
    spark = lists.sparkSession
    members = stored(
        lists.withColumn("digests", F.transform("turns", lambda t: t["digest"])).select(
            "conv_id",
            "digests",
            F.transform("turns", lambda t: t["words"]).alias("words"),
            F.unhex(F.sha2(_bytes("digests"), 256)).alias("key"),
        ),
        "trie-members",
    )
    classes = members.groupBy("key").agg(
        F.first("digests").alias("digests"),
        F.first("words").alias("words"),
        F.count("*").alias("copies"),
        F.min("conv_id").alias("conv"),
    )
    classes = stored(classes, "trie-classes")
    if ranges is None:
        turns = classes.agg(F.sum(F.size("digests") + 1)).first()[0] or 0
        ranges = max(shuffle_width(spark), -(-turns // RANGE_TURNS))
    ranked = stored(
        classes.select("digests", "words", "copies", "conv", "key")
        .repartitionByRange(ranges, "digests")
        .sortWithinPartitions("digests")
        .mapInArrow(
            _ranked,
            "part int, at bigint, size bigint, lcp bigint, words array<bigint>, copies bigint, conv bigint, key binary, ends array<binary>",
        ),
        "trie-sorted",
    )
    borders = _borders(ranked)
    order = spark.createDataFrame(list(zip(borders.numbers, range(ranges), strict=False)), "part int, number int")
    rows = ranked.drop("ends").join(order, "part")

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, part in _parts(batches):
            whole = node_rows(part, number, borders)
            for begin in range(0, whole.num_rows, 10_000):
                yield whole.slice(begin, 10_000)

    nodes = stored(
        rows.repartition(ranges, "number").sortWithinPartitions("number", "at").mapInArrow(built, _NODE),
        "trie-nodes",
    )
    over = stored(_merged(nodes.where("not finished"), len(borders.numbers)), "trie-shared")
    parents = over.select(
        F.col("first_part").alias("parent_part"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("above")
    )
    columns = [
        "conv_id", "depth", "parent_conv_id", "parent_part", "n_convs", "n_children", "n_leaves", "saved_tokens", "key",
    ]
    no_parent = F.lit(None).cast("bigint").alias("parent_conv_id")
    every = nodes.where("finished").select(columns).unionByName(over.withColumn("parent_conv_id", no_parent).select(columns))
    ends = stored(member_digests(members), "trie-digests")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        every.join(parents, ["parent_part", "depth"], "left")
        .join(ends, "key", "left")
        .select(
            "conv_id",
            "depth",
            F.coalesce("parent_conv_id", "above").alias("parent_conv_id"),
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
        )
    )


def _bytes(digests: str) -> Column:
    """Digests end to end, as text that a hash takes."""
    return F.array_join(F.transform(digests, lambda d: F.hex(d)), "")


def _merged(shares: DataFrame, parts: int) -> DataFrame:
    """The nodes that reach over a boundary, from the shares of their ranges."""
    spark = shares.sparkSession
    merged = shares.groupBy("first_part", "depth").agg(
        F.max("part").alias("last_part"),
        F.min("conv_id").alias("conv_id"),
        F.min("parent_part").alias("parent_part"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("kids"),
        F.sum("n_leaves").alias("leaves"),
        F.sum("saved_tokens").alias("saved"),
        F.max("words").alias("words"),
        F.max("key").alias("key"),
    )
    merged = stored(merged, "trie-merged")
    open_kids = merged.groupBy(F.col("parent_part").alias("first_part"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("more")
    )
    counted = merged.join(open_kids, ["first_part", "depth"], "left").withColumn(
        "n_children", F.col("kids") + F.coalesce("more", F.lit(0))
    )
    own = counted.withColumns(
        {
            "own_leaves": F.col("leaves") + (F.col("n_children") == 0).cast("bigint"),
            "own_saved": F.col("saved") + (F.col("n_convs") - 1) * F.col("words"),
        }
    )
    own = stored(own, "trie-own")
    totals = {
        r.first_part: (r.l, r.s)
        for r in own.groupBy("first_part").agg(F.sum("own_leaves").alias("l"), F.sum("own_saved").alias("s")).collect()
    }
    # Shared nodes that begin in a range between a node's first and last are all below it; those that
    # begin in its last range come after it.
    running, rows = [0, 0], []
    for p in range(parts):
        more = totals.get(p, (0, 0))
        rows.append((p, *running, running[0] + more[0], running[1] + more[1]))
        running = [running[0] + more[0], running[1] + more[1]]
    sums = spark.createDataFrame(rows, "part int, l1 bigint, s1 bigint, l2 bigint, s2 bigint")
    chain = "over (partition by first_part order by depth desc)"
    below = own.withColumns(
        {"in_leaves": F.expr(f"sum(own_leaves) {chain}"), "in_saved": F.expr(f"sum(own_saved) {chain}")}
    )
    first = sums.select(F.col("part").alias("first_part"), F.col("l2").alias("l_to"), F.col("s2").alias("s_to"))
    last = sums.select(F.col("part").alias("last_part"), "l1", "s1")
    later = "case when last_part > first_part then {} else 0 end"
    return (
        below.join(first, "first_part")
        .join(last, "last_part")
        .withColumn("n_leaves", F.expr("in_leaves + " + later.format("l1 - l_to")))
        .withColumn("saved_tokens", F.expr("in_saved + " + later.format("s1 - s_to")))
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(rebuilt(turn_lists(table(spark, sf_dir, "conversations"))))


_CRC = """list_reduce(list_prepend(4294967295, list_transform(range(1, len(cast(conv_id as varchar)) + 1),
        lambda i: cast(ascii(cast(conv_id as varchar)[i]) as bigint))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
        lambda x, r: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end))"""
ORACLE_SQL = f"""with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    where conv_id is not null),
own as (
    select conv_id, list(sha256(concat(strlen(role), ':', role, text))
            order by turn nulls first, role, sha256(concat(strlen(role), ':', role, text))) as digests,
        list(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))
            order by turn nulls first, role, sha256(concat(strlen(role), ':', role, text))) as words
    from turns group by conv_id),
heads as (select *, xor({_CRC}, 4294967295) % 4 as h from own),
rebuilt as (
    select c.conv_id, list_concat(coalesce(b.digests, [])[1:c.h], c.digests[c.h + 1:]) as digests,
        list_concat(coalesce(b.words, [])[1:c.h], c.words[c.h + 1:]) as words
    from heads c left join own b on b.conv_id = c.conv_id - c.conv_id % 20),
prefixes as (
    select conv_id, unnest(range(0, len(digests) + 1)) as depth, digests, words from rebuilt),
nodes as (
    select array_to_string(digests[1:depth], '') as path, depth, min(conv_id) as conv_id, count(*) as n_convs,
        any_value(words[depth]) as words,
        sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id)
            filter (len(digests) = depth), '')) as ends_sha256
    from prefixes group by 1, 2),
kids as (
    select path[1:64 * (depth - 1)] as path, depth - 1 as depth, count(*) as n_children from nodes where depth > 0 group by 1, 2),
full_nodes as (
    select n.*, coalesce(k.n_children, 0) as n_children from nodes n left join kids k using (path, depth)),
above as (
    select path[1:64 * d] as path, d as depth, n_children, (n_convs - 1) * coalesce(words, 0) as own
    from (select *, unnest(range(0, depth + 1)) as d from full_nodes)),
sums as (
    select path, depth, count(*) filter (n_children = 0) as n_leaves, sum(own) as saved_tokens from above group by 1, 2)
select n.conv_id, cast(n.depth as bigint) as depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, s.n_leaves,
    cast(s.saved_tokens as bigint) as saved_tokens, n.ends_sha256
from full_nodes n join sums s using (path, depth)
left join nodes p on p.depth = n.depth - 1 and p.path = n.path[1:64 * (n.depth - 1)]"""
