"""The prefix trie of rebuilt conversations, from composable fingerprints.

A conversation c is rebuilt from the head of its base conversation and its own turns after as many; no rebuilt
text is ever made. Turns are elements of a monoid: a sequence of turns is a pair (hash, power), and the pair of two
sequences in a row is (h1 p2 + h2, p1 p2) modulo the prime 2**61 - 1, for two bases.

1. The turns are stored once with a digest; the digests are sorted by conversation and turn over ranges of equal
   size, and each task multiplies up the products of the prefixes it holds. The products of whole parts of the few
   conversations that cross a range's end are composed on the driver (at most one row for each range).
2. With P the products of the prefixes of stored conversations, the product of the rebuilt conversation that takes the first
   ``b`` turns of its base and its own turns from ``h`` on is, at its own turn j, P[j].hash + D P[j].power with
   D = (Pbase[b].hash - P[h].hash) base^-h: one number for each conversation, whatever its length. So a rebuilt
   prefix is a row (conversation, depth, fingerprint, reference of its last stored turn).
3. Rows of equal depth and fingerprint are a node. The parent's fingerprint follows from a node's own and its last turn's
   element, so if the last turns of a node's members are equal for every node, the whole prefixes are, by
   induction. Nodes whose members refer to different stored turns are held against the stored roles and texts; a
   node that fails (a chance of about 2**-122 a pair) starts everything anew with other bases.
4. A node belongs to its smallest member r, and the nodes of one conversation are the end of its path. Sums over subtrees
   therefore need no walk through the levels: leaves and weights are added up for each owner, and a node's sum is
   that of its members' totals, less what its own owner has above it.
5. The hash of a node's ends is taken over chunks of joined ids that come in order, so no list of ids is ever held.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetvolt.llm.common import bounded_batches, stored

PRIME = (1 << 61) - 1
FAMILY = 5                   # conversation c starts as c - c % FAMILY does
HEADS = 9                    # ... for crc32(c) % HEADS turns
CHUNK = 4096                 # ids of a chunk of a node's ends
BLOCK = 4096                 # depths of a block of one conversation's nodes
TRIES = 4

_M31, _M30, _P = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1), np.uint64(PRIME)


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x >> np.uint64(61)) + (x & _P)
    return np.where(x >= _P, x - _P, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a b modulo the prime, for numbers below it, in 64-bit steps."""
    au, ad, bu, bd = a >> np.uint64(31), a & _M31, b >> np.uint64(31), b & _M31
    mid = ad * bu + au * bd
    return _reduced(au * bu * np.uint64(2) + (mid >> np.uint64(30)) + ((mid & _M30) << np.uint64(31)) + ad * bd)


def _sums(x: np.ndarray) -> np.ndarray:
    """Running sums modulo the prime (fewer than 2**32 numbers)."""
    low, high = np.cumsum(x & _M31, dtype=np.uint64), np.cumsum(x >> np.uint64(31), dtype=np.uint64)
    return _reduced(times(_reduced(high), np.full(len(x), 1 << 31, np.uint64)) + _reduced(low))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, times(out, np.full(len(out), pow(base, len(out), PRIME), np.uint64))])
    return out[:n]


def bases(attempt: int) -> tuple[int, int]:
    drawn = [int.from_bytes(hashlib.sha256(f"base {attempt} {k}".encode()).digest(), "big") % (PRIME - 1000) + 500 for k in (1, 2)]
    return drawn[0], drawn[1]


def products(starts: np.ndarray, elements: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, power) of the prefix that ends at each place, inside the groups that begin at ``starts``."""
    n = len(elements)
    up, down = _powers(base, n + 1), _powers(pow(base, -1, PRIME), n + 1)
    at = np.arange(n)
    first = starts[np.searchsorted(starts, at, "right") - 1]
    sums = np.concatenate([[np.uint64(0)], _sums(times(elements, down[:n]))])
    own = _reduced(sums[1:] + (_P - sums[first]))
    return times(own, up[:n]), up[at - first + 1]


_SCANNED = ("conv_id long, part int, pos long, row long, bytes long, t1 long, t2 long, h1 long, p1 long, h2 long, p2 long, "
            "ends boolean")


def _scan(attempt: int):
    """Products of the prefixes of each conversation inside one sorted range. ``ends`` marks the last row of each
    conversation in the range."""
    both = bases(attempt)

    def run(batches):
        part = TaskContext.get().partitionId()
        carry = (None, 0, 0, 1, 0, 1)         # conversation, turns, (hash, power) twice
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column("conv_id").to_numpy()
            n = len(conv)
            digest = np.array([int(x, 16) for x in batch.column("digest").to_pylist()], object)
            elements = [np.array([(x >> s) % PRIME for x in digest], np.uint64) for s in (0, 64)]
            starts = np.concatenate([[0], np.flatnonzero(conv[1:] != conv[:-1]) + 1])
            first = starts[np.searchsorted(starts, np.arange(n), "right") - 1]
            pos = np.arange(n) - first + 1
            out = [products(starts, e, b) for e, b in zip(elements, both)]
            if carry[0] == conv[0]:           # goes on from the batch before
                to = int(starts[1]) if len(starts) > 1 else n
                pos[:to] += carry[1]
                for k, (h, p) in enumerate(out):
                    h0, p0 = (np.full(to, x, np.uint64) for x in carry[2 + 2 * k:4 + 2 * k])
                    h[:to] = _reduced(times(h0, p[:to]) + h[:to])
                    p[:to] = times(p0, p[:to])
            ends = np.zeros(n, bool)
            ends[np.concatenate([starts[1:] - 1, [n - 1]])] = True
            if held is not None:
                if carry[0] == conv[0]:
                    held[-1][-1] = False
                yield _record(held)
            held = [conv, np.full(n, part, np.int32), pos, batch.column("row").to_numpy(), batch.column("bytes").to_numpy(),
                    *(e.view(np.int64) for e in elements), *(x.view(np.int64) for pair in out for x in pair), ends]
            carry = (conv[-1], int(pos[-1]), *(int(x[-1]) for pair in out for x in pair))
        if held is not None:
            yield _record(held)

    return run


def _record(columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns],
                                      names=[c.split()[0] for c in _SCANNED.split(", ")])


def _mod(x: str) -> str:
    return f"cast(({x}) % {PRIME} as bigint)"


def _big(x: str) -> str:
    return f"cast({x} as decimal(19,0))"


def _prefixes(turns: DataFrame, attempt: int) -> DataFrame:
    """conv_id, pos, products: those of the whole conversation up to its turn ``pos``, as a stored table."""
    order = ["conv_id", F.col("turn").asc_nulls_first(), "digest", "row"]
    light = turns.select("conv_id", "turn", "digest", "row", "bytes").repartitionByRange(*order).sortWithinPartitions(*order)
    scanned = stored(light.select("conv_id", "digest", "row", "bytes").mapInArrow(_scan(attempt), _SCANNED), "scanned")
    # Conversations that cross a range's end: at most one for each range goes on into the next one.
    parts = scanned.where("ends")
    crossing = parts.groupBy("conv_id").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi").select("conv_id")
    rows = parts.join(crossing, "conv_id", "left_semi").select("conv_id", "part", "pos", "h1", "p1", "h2", "p2").collect()
    carried, before = [], None
    for r in sorted(rows, key=lambda r: (r["conv_id"], r["part"])):
        if before is None or before[0] != r["conv_id"]:
            before = (r["conv_id"], 0, 0, 1, 0, 1)
        else:
            carried.append((r["conv_id"], r["part"], *before[1:]))
        _, n, h1, p1, h2, p2 = before
        before = (r["conv_id"], n + r["pos"], (h1 * r["p1"] + r["h1"]) % PRIME, p1 * r["p1"] % PRIME,
                  (h2 * r["p2"] + r["h2"]) % PRIME, p2 * r["p2"] % PRIME)
    if not carried:
        return scanned.drop("part", "ends")
    extra = turns.sparkSession.createDataFrame(carried, "c long, at int, n0 long, g1 long, q1 long, g2 long, q2 long")
    joined = scanned.join(extra, (F.col("conv_id") == F.col("c")) & (F.col("part") == F.col("at")), "left")

    def shifted(name: str, value: str) -> Column:
        return F.expr(f"case when c is null then {name} else {value} end").alias(name)

    return joined.select(
        "conv_id", shifted("pos", "pos + n0"), "row", "bytes", "t1", "t2",
        *(shifted(*x) for k in "12" for x in ((f"h{k}", _mod(f"{_big(f'g{k}')} * {_big(f'p{k}')} + h{k}")),
                                              (f"p{k}", _mod(f"{_big(f'q{k}')} * {_big(f'p{k}')}")))))


def _rebuilt(prefix: DataFrame, attempt: int) -> DataFrame:
    """One row for each prefix of each rebuilt conversation: conv_id, depth, fingerprint, element and reference of its last
    turn, and whether the conversation ends there. Depth 0 has neither element nor reference."""
    head = F.struct("pos", "h1", "h2", "row", "bytes", "t1", "t2")
    convs = prefix.groupBy("conv_id").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(
        F.when(F.col("pos") < HEADS, head))).alias("heads"))          # fewer than HEADS rows of each
    convs = stored(convs, "convs")
    own = convs.withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int"))
    own = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY)
    base = convs.select(F.col("conv_id").alias("of"), F.col("heads").alias("base_heads"))
    both = own.join(base, F.col("base") == F.col("of"), "left")
    both = both.withColumn("b", F.least("h", F.coalesce(F.size("base_heads"), F.lit(0)).cast("int")))
    both = both.withColumn("b", F.greatest("b", F.lit(0)))
    both = both.withColumn("total", F.col("b") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))

    def at(heads: str, place: str, name: str) -> str:
        return f"coalesce(try_element_at({heads}, nullif({place}, 0)).{name}, 0)"

    inverse = [[pow(b, -k, PRIME) for k in range(HEADS)] for b in bases(attempt)]
    shift = [_mod(f"cast({at('base_heads', 'b', f'h{k}')} - {at('heads', 'h', f'h{k}')} + {PRIME} as decimal(20,0)) % {PRIME} * "
                  f"cast(element_at(array({', '.join(f'{x}L' for x in inverse[k - 1])}), h + 1) as decimal(19,0))") for k in (1, 2)]
    both = stored(both.withColumns({"d1": F.expr(shift[0]), "d2": F.expr(shift[1])})
                  .select("conv_id", "h", "b", "total", "d1", "d2", F.slice("base_heads", F.lit(1), F.col("b")).alias("taken")), "rebuilt")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = both.select("conv_id", zero.alias("depth"), zero.alias("f1"), zero.alias("f2"), none.alias("row"), zero.alias("bytes"),
                       none.alias("t1"), none.alias("t2"), (F.col("total") == 0).alias("is_end"))
    heads = both.select("conv_id", "total", F.explode("taken").alias("x")).select(
        "conv_id", F.col("x.pos").alias("depth"), F.col("x.h1").alias("f1"), F.col("x.h2").alias("f2"), "x.row", "x.bytes",
        "x.t1", "x.t2", (F.col("x.pos") == F.col("total")).alias("is_end"))
    tail = prefix.join(both.select("conv_id", "h", "b", "total", "d1", "d2"), "conv_id").where("pos > h")
    depth = F.col("pos") - F.col("h") + F.col("b")
    tail = tail.select("conv_id", depth.alias("depth"),
                       *(F.expr(_mod(f"{_big(f'd{k}')} * {_big(f'p{k}')} + h{k}")).alias(f"f{k}") for k in (1, 2)),
                       "row", "bytes", "t1", "t2", (depth == F.col("total")).alias("is_end"))
    return stored(root.unionByName(heads).unionByName(tail), "prefixes")


KEY = ["depth", "f1", "f2"]


def _differing(nodes: DataFrame, rows: DataFrame, turns: DataFrame) -> int:
    """Nodes whose members' last turns are not equal, by the stored roles and texts."""
    several = nodes.where("lo < hi").select(*KEY)
    refs = rows.join(several, KEY, "left_semi").select(*KEY, "row").distinct()
    texts = turns.select("row", "role", "text")
    held = refs.join(texts, "row").groupBy(*KEY).agg(
        F.min("role").alias("a"), F.max("role").alias("b"), F.min("text").alias("c"), F.max("text").alias("d"))
    return held.where("a != b OR c != d").limit(1).count()


def _chunks(batches):
    """The ids of each node in order, joined in chunks."""
    held: list = []
    key = None
    names = [*KEY, "first", "body"]

    def flush():
        body = ",".join(map(str, held)).encode()
        return pa.RecordBatch.from_arrays([*(pa.array([k], pa.int64()) for k in key), pa.array([held[0]], pa.int64()),
                                           pa.array([body], pa.binary())], names=names)

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in (*KEY, "conv_id")]
        for *k, c in zip(*columns):
            if held and (k != key or len(held) == CHUNK):
                yield flush()
                held.clear()
            key = k
            held.append(c)
    if held:
        yield flush()


def _digests(batches):
    """SHA-256 over the chunks of each node, which come in order."""
    key, state, done = None, None, []

    def out():
        cols = list(zip(*done))
        done.clear()
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())],
                                          names=[*KEY, "ends_sha256"])

    for batch in batches:
        for *k, body in zip(*(batch.column(c).to_pylist() for c in (*KEY, "body"))):
            if k == key:
                state.update(b",")
            else:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = k, hashlib.sha256()
            state.update(body)
        if len(done) >= 4096:
            yield out()
    if key is not None:
        done.append((*key, state.hexdigest()))
        yield out()


def _ends(rows: DataFrame) -> DataFrame:
    order = [*KEY, "conv_id"]
    ids = rows.where("is_end").select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    chunks = ids.mapInArrow(_chunks, "depth long, f1 long, f2 long, first long, body binary")
    return (chunks.repartition(*KEY).sortWithinPartitions(*KEY, "first").select(*KEY, "body")
            .mapInArrow(_digests, "depth long, f1 long, f2 long, ends_sha256 string"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations: conv_id (smallest member), depth, parent_conv_id (null
    for the root), n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``conversations`` has conv_id, turn, role, text. Turns come by ``turn``, null first; turns that tie come by the MD5 digest of
    the digests of role and text. A null role or text is empty. Rows that repeat a turn are turns of their own. A row without
    conv_id belongs to no conversation. Conversation c is rebuilt from the first h = crc32(c) % 9 turns of conversation
    c - c % 5 (all, if fewer; none, if it is not there) and its own turns after its first h; one without a turn left is
    a member of the root alone. saved_tokens counts UTF-8 bytes. Texts of any length are read twice, when the turns are stored and
    where equality is verified; conversations of any length are cut into ranges. An empty table has no node. Extra columns
    are not read.
    """
    spark = conversations.sparkSession
    bounded_batches(spark, 10_000)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = stored(conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), role.alias("role"), text.alias("text"),
        F.octet_length(text).cast("long").alias("bytes"), F.md5(F.concat(F.md5(role), F.md5(text))).alias("digest"),
        F.monotonically_increasing_id().alias("row")), "turns")
    for attempt in range(TRIES):
        rows = _rebuilt(_prefixes(turns, attempt), attempt)
        nodes = stored(rows.groupBy(*KEY).agg(
            F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("bytes").alias("bytes"), F.max("t1").alias("t1"),
            F.max("t2").alias("t2"), F.min("row").alias("lo"), F.max("row").alias("hi")), "nodes")
        if not _differing(nodes, rows, turns):
            break
    else:
        raise RuntimeError("prefixes of different turns share fingerprints under all bases")

    # The parent's fingerprint: the last turn taken off.
    off = [pow(b, -1, PRIME) for b in bases(attempt)]
    up = [F.expr(f"case when depth > 0 then {_mod(f'cast((f{k} - t{k} + {PRIME}) % {PRIME} as decimal(19,0)) * cast({off[k - 1]} as decimal(19,0))')} end")
          for k in (1, 2)]
    tree = nodes.select(*KEY, "conv_id", "n_convs", (F.col("depth") - 1).alias("up"), up[0].alias("u1"), up[1].alias("u2"),
                        ((F.col("n_convs") - 1) * F.col("bytes")).alias("w"))
    children = tree.where("depth > 0").groupBy("up", "u1", "u2").agg(F.count("*").alias("n_children")).select(
        F.col("up").alias("depth"), F.col("u1").alias("f1"), F.col("u2").alias("f2"), "n_children")
    # What each owner has above a node, over blocks of depths.
    block = F.floor(F.col("depth") / BLOCK)
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tree = tree.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    tree = stored(tree.withColumn("block", block).withColumn("upto", F.sum("w").over(inside)), "tree")
    blocks = tree.groupBy("conv_id", "block").agg(F.sum("w").alias("in_block"))
    above = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    blocks = blocks.select("conv_id", "block", (F.sum("in_block").over(above) - F.col("in_block")).alias("blocks_above"))
    owners = tree.groupBy("conv_id").agg(F.sum("w").alias("weight"), F.count_if(F.col("n_children") == 0).alias("leaf"))
    below = (rows.select(*KEY, "conv_id").join(owners.where("weight > 0 OR leaf > 0"), "conv_id").groupBy(*KEY)
             .agg(F.sum("leaf").alias("n_leaves"), F.sum("weight").alias("under")))
    parents = tree.where("n_children > 0").select(F.col("depth").alias("up"), F.col("f1").alias("u1"), F.col("f2").alias("u2"),
                                                  F.col("conv_id").alias("parent_conv_id"))
    out = (tree.join(below, KEY).join(blocks, ["conv_id", "block"]).join(_ends(rows), KEY, "left")
           .join(parents, ["up", "u1", "u2"], "left"))
    out = out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("under") - F.col("blocks_above") - F.col("upto") + F.col("w")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
    return out
