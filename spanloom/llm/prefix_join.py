"""Jaccard join of word shingles by grouped prefixes (operator 4).

Two documents link when ``100 * intersection >= percent * union`` of their shingle sets. The result is exact up to
collisions of 64-bit hashes.

1. Equal sets collapse to one node, named by a hash of the set. Everything up to the components is about nodes; ids come back
   at the end. A node's text is read from the row of its smallest id.
2. A global order of shingles puts rare ones first: by the magnitude of their count in a sketch of fixed size that all
   documents are added to, then by hash. Sets that link share a shingle in the prefixes of this order.
3. Sets with equal prefixes and size are gathered under a leader; so are sets with an equal minhash, as near copies differ
   in the rare shingles that come first. The leader is the set whose shingles are the most frequent on average: of many
   copies of one text, the one that was edited least. A set that links to its leader joins its group; others are groups of
   their own. Large groups of copies thereby count once in what follows.
4. Groups that share a prefix shingle are a candidate pair (rows of a frequent shingle are dealt to blocks, and each pair of
   blocks is a run of its own, so that no run has more than about ``2 * BLOCK`` rows) if sizes, positions and bitmaps allow a link. A set's bitmap has
   the parity of its shingles on each of 256 places, so that two bitmaps never differ in more places than the sets do in
   shingles. The pair is then filtered by the exact distance of the leaders: Jaccard distance is a metric, so members can
   only link when the leaders' distance is at most the limit plus both radii.
5. Leaders that link make the groups one component. Pairs left in between, unless the groups are already connected, are
   expanded: the members of these groups pass the filters of step 4 on their own, each pair of different groups, and what is
   left is verified.

Defined results: a null text and one without words have an empty set, which links with nothing; its component is its own
id. Copies and repeated rows link with each other. Rows with a null id are left out. Rows that repeat an id with another text
each get their own number of shingles and the component of their own text.
Texts are read whole. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import Scratch, in_arrow, materialize, small_or_shuffled
from .shingles import mix, sets

#: Counters of the sketch (fixed, whatever the input), its pieces, minhashes.
SKETCH, PIECES, HASHES = 1 << 20, 64, 4
#: Tasks that count for the sketch, as each hands on all counters: more splits of the input are read one after another.
SKETCH_TASKS = 4_096
#: Rows of one shingle in the index from which on they are dealt to several tasks. Each row then moves once for every block, so small blocks cost disk.
BLOCK = 4_096
#: Rows of the index that are shuffled at once, about 1 GB; of a larger one, slices of its shingles follow one another.
SLICE_ROWS = 1 << 24
_SHIFT = np.uint64(64 - (SKETCH.bit_length() - 1))


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1 if n else 0


def sketch(docs: DataFrame, k: int) -> np.ndarray:
    """How many sets fall on each counter: each task adds up its own, pieces of all tasks are added by shuffle."""
    width = SKETCH // PIECES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH, np.int64)
        for b in batches:
            for s in range(0, b.num_rows, 512):
                own = [x >> _SHIFT for x in sets(b.column(0).slice(s, 512).to_pylist(), k)]
                if own:
                    total += np.bincount(np.concatenate(own).astype(np.int64), minlength=SKETCH)
        if total.any():
            yield pa.record_batch({"piece": pa.array(range(PIECES), pa.int32()), "counts": pa.array([total[i * width : (i + 1) * width].astype("<u4").tobytes() for i in range(PIECES)], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for i, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                sums[i] = sums.get(i, 0) + np.frombuffer(c, "<u4").astype(np.int64)
        if sums:  # magnitudes are all that the order needs
            yield pa.record_batch({"piece": pa.array(list(sums), pa.int32()), "counts": pa.array([np.frexp(v.astype(float))[1].astype(np.uint8).tobytes() for v in sums.values()], pa.binary())})

    kind = "piece int, counts binary"
    got = in_arrow(in_arrow(docs.select("text").coalesce(SKETCH_TASKS), count, kind).repartition(PIECES, "piece"), add, kind).collect()
    out = np.zeros(SKETCH, np.uint8)
    for r in got:
        out[r["piece"] * width : (r["piece"] + 1) * width] = np.frombuffer(r["counts"], np.uint8)
    return out


def in_order(x: np.ndarray, magnitudes: np.ndarray, n: int) -> np.ndarray:
    """The first n shingles of a set in the global order."""
    key = (magnitudes[x >> _SHIFT].astype(np.uint64) << np.uint64(58)) | (x >> np.uint64(6))
    near = np.argpartition(key, n - 1)[:n] if n < len(x) else np.arange(len(x))
    return x[near[np.lexsort((x[near], key[near]))]]


def bitmap(mixed: np.ndarray) -> np.ndarray:
    """256 parities of the shingles that fall on each place."""
    odd = (np.bincount((mixed >> np.uint64(56)).astype(np.int64), minlength=256) & 1).astype(np.uint8)
    return np.packbits(odd).view("<i8")


def profiles(docs: DataFrame, k: int, percent: int, magnitudes: Broadcast) -> DataFrame:
    """``id, h, n, node, set, keys, prefix, edits, bits`` of every document; ``set`` are two hashes and the size of a set, ``node`` a hash of these.

    ``edits`` is low for a set of frequent shingles.
    """
    names = ["id", "h", "n", "sig_a", "sig_b", "keys", "prefix", "edits", "bits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = magnitudes.value
        salts = mix(np.arange(1, HASHES + 1, dtype=np.uint64))
        for b in batches:
            for s in range(0, b.num_rows, 512):
                part = b.slice(s, 512)
                rows: list[list] = [[] for _ in range(7)]
                with np.errstate(over="ignore"):
                    for x in sets(part.column(2).to_pylist(), k):
                        y = mix(x)
                        p = in_order(x, m, prefix_length(len(x), percent)) if len(x) else x
                        same = np.uint64(len(x)) + (mix(p) * np.arange(1, 2 * len(p), 2, dtype=np.uint64)).sum(dtype=np.uint64)
                        keys = [int((x ^ a).min()) for a in salts] + [int(same)] if len(x) else []
                        for out, v in zip(rows, (len(x), y.sum(dtype=np.uint64), (y * y).sum(dtype=np.uint64), keys, p.astype("<u8").tobytes(), 255 - float(m[x >> _SHIFT].mean()) if len(x) else 0.0, bitmap(y))):
                            out.append(v)
                signed = lambda v: np.array(v, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(rows[0], pa.int32()), pa.array(signed(rows[1])), pa.array(signed(rows[2])), pa.array([signed(v) for v in rows[3]], pa.list_(pa.int64())), pa.array(rows[4], pa.binary()), pa.array(rows[5], pa.float64()), pa.array(rows[6], pa.list_(pa.int64()))],
                    names=names,
                )

    out = in_arrow(docs.select("id", "h", "text"), run, "id bigint, h bigint, n int, sig_a bigint, sig_b bigint, keys array<bigint>, prefix binary, edits double, bits array<bigint>")
    return out.withColumns({"node": F.xxhash64("sig_a", "sig_b", "n"), "set": F.struct("sig_a", "sig_b", "n")}).drop("sig_a", "sig_b")


def sets_of(rows: DataFrame, scratch: Scratch, kept: Scratch) -> tuple[DataFrame, DataFrame]:
    """``rows`` of ``profiles`` in which unlike sets have unlike nodes, and ``node, id, h, copies`` of the row that each set is read from.

    Among 1e10 sets two or three pairs share a hash of 64 bits; what ``set`` tells apart gets another node, until none is shared.
    """
    salt = 0
    while True:
        each = rows.filter("n > 0").groupBy("node", "set", "id", "h").agg(F.count("*").alias("copies"))
        same = each.groupBy("node").agg(F.min(F.struct("id", "h", "copies")).alias("m"), F.min("set").alias("lo"), F.max("set").alias("hi"))
        same = materialize(same.select("node", "m.*", (F.col("lo") != F.col("hi")).alias("shared")), "same_sets", scratch)
        shared = same.filter("shared").select("node", F.lit(True).alias("shared"))
        if shared.isEmpty():
            return rows, same.drop("shared")
        salt += 1
        node = F.when(F.col("shared"), F.xxhash64("set.sig_a", "set.sig_b", "set.n", F.lit(salt))).otherwise(F.col("node"))
        rows = materialize(rows.join(small_or_shuffled(shared, "shared_nodes", scratch), "node", "left").withColumn("node", node).drop("shared"), "profiles", kept)


def similarities(pairs: DataFrame, docs: DataFrame, same: DataFrame, repeated: bool, k: int, scratch: Scratch) -> DataFrame:
    """pairs: distinct nodes ``x, y``. Adds their ids ``ix, iy``, and ``both`` and ``either``, the sizes of intersection and union.

    same: ``node, id, h``, the row of docs that has a node's text; repeated: whether several rows may be equal to it.
    """
    # A short list reaches the scan, so that only these texts move.
    ids = small_or_shuffled(pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct().join(same.select("node", "id", "h"), "node"), "ids", scratch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = zstandard.ZstdCompressor(level=3)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([c.compress((t or "").encode()) for t in b.column(2).to_pylist()], pa.binary())], names=["node", "id", "s"])

    # Compressed text is a quarter of a set.
    own = in_arrow(docs.join(ids, ["id", "h"]).select("node", "id", "text"), run, "node bigint, id bigint, s binary")
    if repeated:
        own = materialize(own.groupBy("node").agg(F.first("id").alias("id"), F.first("s").alias("s")), "texts", scratch)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = zstandard.ZstdDecompressor()
        last: tuple[int | None, np.ndarray] = None, np.zeros(0, np.uint64)
        for b in batches:
            for s in range(0, b.num_rows, 256):
                part = b.slice(s, 256)
                ys = part.column(1).to_pylist()
                new = [i for i, y in enumerate(ys) if y != (ys[i - 1] if i else last[0])]  # rows come by y, and a leader has many
                left = sets((d.decompress(x.as_buffer()).decode() for x in part.column(4)), k)
                right = sets((d.decompress(part.column(5)[i].as_buffer()).decode() for i in new), k)
                both, either, fresh = [], [], set(new)
                for i, a in enumerate(left):
                    if i in fresh:
                        last = ys[i], next(right)
                    c = last[1]
                    if len(a) > len(c):
                        a, c = c, a
                    n = int((c[np.minimum(np.searchsorted(c, a), len(c) - 1)] == a).sum()) if len(a) else 0
                    both.append(n)
                    either.append(len(a) + len(c) - n)
                yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(both, pa.int64()), pa.array(either, pa.int64())], names=["x", "y", "ix", "iy", "both", "either"])

    p = pairs.select("x", "y").join(own.select(F.col("node").alias("x"), F.col("id").alias("ix"), F.col("s").alias("sx")), "x")
    p = p.join(own.select(F.col("node").alias("y"), F.col("id").alias("iy"), F.col("s").alias("sy")), "y").select("x", "y", "ix", "iy", "sx", "sy")
    return in_arrow(p, compare, "x bigint, y bigint, ix bigint, iy bigint, both bigint, either bigint")


def _runs(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows ``run, g, pos, lo, hi, slack``, four of bitmap, ``own`` and ``side``, sorted by run, become pairs of ``g`` with different ``own``.

    A run holds rows of one token, all of one block (side 0) or of two (sides 1 and 2, of which only pairs across are wanted).
    Its rows may span batches.
    """
    kept: np.ndarray | None = None
    for b in batches:
        rows = np.stack([c.to_numpy() for c in b.columns], 1).astype(np.int64)
        if kept is not None:
            rows = np.concatenate([kept, rows])
        if not len(rows):
            continue
        cut = int(np.searchsorted(rows[:, 0], rows[-1, 0]))  # the last run may go on
        kept = rows[cut:]
        yield from _pairs(rows[:cut], percent)
    if kept is not None:
        yield from _pairs(kept, percent)


def _possible(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sizes and positions leave room for a link between members of two groups that share a token."""
    lo_a, hi_a, lo_b, hi_b = a[:, 3], a[:, 4], b[:, 3], b[:, 4]
    sizes = (100 * hi_a >= percent * lo_b) & (100 * hi_b >= percent * lo_a)
    # The shared token and what may follow it, against the least overlap of the smallest members.
    most = 1 + np.minimum(hi_a - a[:, 2] - 1, hi_b - b[:, 2] - 1)
    ok = sizes & (most * (100 + percent) >= percent * (lo_a + lo_b)) & (a[:, 1] != b[:, 1]) & (a[:, 10] != b[:, 10]) & ((a[:, 11] == 0) | (a[:, 11] != b[:, 11]))
    # Places in which the leaders' bitmaps differ, less what members may differ from their leaders.
    at = np.flatnonzero(ok)
    differ = np.bitwise_count(a[at, 6:10] ^ b[at, 6:10]).sum(1, dtype=np.int64) - a[at, 5] - b[at, 5]
    ok[at] = differ * (100 + percent) <= (100 - percent) * (hi_a[at] + hi_b[at])
    return ok


def _pairs(rows: np.ndarray, percent: int, block: int = 256) -> Iterator[pa.RecordBatch]:
    if not len(rows):
        return
    starts = np.flatnonzero(np.concatenate([[True], rows[1:, 0] != rows[:-1, 0]]))
    sizes = np.diff(np.append(starts, len(rows)))
    found: list[np.ndarray] = []
    held = 0

    def keep(a: np.ndarray, b: np.ndarray) -> None:
        nonlocal held
        ok = _possible(a, b, percent)
        p = np.stack([np.minimum(a[ok, 1], b[ok, 1]), np.maximum(a[ok, 1], b[ok, 1])], 1)
        if len(p):
            found.append(p)
            held += len(p)

    def out() -> Iterator[pa.RecordBatch]:
        nonlocal held
        if found:
            p = np.concatenate(found)
            p = p[np.lexsort((p[:, 1], p[:, 0]))]
            p = p[np.concatenate([[True], (p[1:] != p[:-1]).any(1)])]
            found.clear()
            held = 0
            yield pa.record_batch({"x": pa.array(p[:, 0]), "y": pa.array(p[:, 1])})

    def across(few: np.ndarray, many: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(few), block):
            a = few[i : i + block]
            for j in range(0, len(many), block):
                b = many[j : j + block]
                u, v = np.divmod(np.arange(len(a) * len(b)), len(b))
                keep(a[u], b[v])
                if held > 100_000:
                    yield from out()

    for n in range(2, 9):  # short runs together, pair of places by pair of places
        at = starts[sizes == n]
        if len(at):
            for i in range(n):
                for j in range(i):
                    keep(rows[at + j], rows[at + i])
            if held > 100_000:
                yield from out()
    # In a pair's first common shingle, the smaller set has it near enough to the start for a partner of its own size.
    early = (rows[:, 4] - rows[:, 2]) * (100 + percent) >= 2 * percent * rows[:, 3]
    for s, n in zip(starts[sizes > 8].tolist(), sizes[sizes > 8].tolist()):
        own = rows[s : s + n]
        small = own[early[s : s + n]]
        # Members of one group aren't compared; where each row is a group of its own, all are taken together.
        alone = (own[:, 10] == own[:, 1]).all()
        for side in np.unique(small[:, 11]).tolist():
            ours, theirs = (small[small[:, 11] == side], own[own[:, 11] == 3 - side]) if side else (small, own)
            for g in [None] if alone else np.unique(ours[:, 10]).tolist():
                few, many = (ours, theirs) if g is None else (ours[ours[:, 10] == g], theirs[theirs[:, 10] != g])
                yield from across(few, many)
    yield from out()


def link_components(docs: DataFrame, k: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_shingles, component_id`` of every document; the component is the smallest id that links reach."""
    found = _linked(docs.filter(F.col(id_col).isNotNull()), k, percent, id_col, text_col, Scratch(docs.sparkSession))
    return found.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), F.col("c").alias("component_id"))


def _linked(docs: DataFrame, k: int, percent: int, id_col: str, text_col: str, kept: Scratch) -> DataFrame:
    """``id, h, n, c, node, root`` of every document: a hash of its text, the size of its set, the component, its set and the set that names the component.

    The set that names a component is one of its smallest id's. A row without an id counts as one of the largest id.

    ``kept`` gets the tables that the result reads; all others are deleted.
    """
    scratch, block, slice_rows = Scratch(docs.sparkSession), BLOCK, SLICE_ROWS
    docs = docs.select(_known(docs[id_col]).alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    magnitudes = docs.sparkSession.sparkContext.broadcast(sketch(docs, k))
    rows = materialize(profiles(docs, k, percent, magnitudes), "profiles", kept)
    rows, same = sets_of(rows, scratch, kept)
    repeated = same.filter("copies > 1").limit(1).count() > 0
    reps = rows.join(same.select("node", "id", "h"), ["node", "id", "h"], "left_semi")
    reps = reps.groupBy("node").agg(F.min(F.struct("n", "keys", "prefix", "edits", "bits")).alias("m")).select("node", "m.*")

    # Leaders of sets with an equal key, and which sets link to them.
    keyed = reps.select("node", "n", "edits", F.posexplode("keys").alias("j", "key"))
    leaders = keyed.groupBy("j", "key").agg(F.min(F.struct("edits", "node", "n")).alias("l"), F.count("*").alias("c")).filter("c > 1").select("j", "key", "l")
    led = keyed.join(leaders, ["j", "key"]).select(F.col("node").alias("x"), F.col("l.node").alias("y"), F.col("n").alias("nx"), F.col("l.n").alias("ny"))
    led = led.filter((F.col("x") != F.col("y")) & (100 * F.col("nx") >= percent * F.col("ny")) & (100 * F.col("ny") >= percent * F.col("nx"))).select("x", "y").distinct()
    led = similarities(materialize(led, "led", scratch), docs, same, repeated, k, scratch).filter(F.col("both") * 100 >= F.col("either") * percent)
    led = materialize(led.withColumns({"d": 1 - F.col("both") / F.col("either"), "delta": F.col("either") - F.col("both")}), "followers", scratch)
    own = led.groupBy("x").agg(F.min(F.struct("d", "y", "delta")).alias("c")).select(F.col("x").alias("node"), "c.*")
    members = reps.select("node", "n", "prefix", "bits").join(own, "node", "left").select(
        "node", "n", F.coalesce("y", "node").alias("g"), F.coalesce("d", F.lit(0.0)).alias("d"), F.coalesce("delta", F.lit(0)).alias("delta"), F.col("y").isNotNull().alias("led"), "prefix", "bits"
    )
    members = materialize(members, "members", scratch)
    groups = members.filter("led").groupBy("g").agg(F.max("d").alias("r"), F.max("delta").alias("slack"))
    groups = materialize(groups.join(members.select(F.col("node").alias("g"), "bits"), "g"), "groups", scratch)

    # Prefix shingles of groups; those of followers are added up before they move.
    def tokens(batches: Iterator[pa.RecordBatch], part: int, parts: int) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = [np.frombuffer(x.as_buffer(), "<i8") for x in b.column(2)]
            each = np.array([len(x) for x in t], np.int64)
            row = np.repeat(np.arange(len(t)), each)
            pos = np.arange(len(row)) - (np.cumsum(each) - each)[row]
            token = np.concatenate([*t, np.zeros(0, np.int64)])
            here = np.flatnonzero((token & (parts - 1)) == part)
            token, row, pos = token[here], row[here], pos[here]
            n = pa.array(b.column(1).to_numpy()[row])
            bits = b.column(3).flatten().to_numpy().reshape(-1, 4)[row]
            yield pa.record_batch({"token": pa.array(token), "g": pa.array(b.column(0).to_numpy()[row]), "pos": pa.array(pos, pa.int32()), "lo": n, "hi": n, **{f"b{i}": pa.array(bits[:, i]) for i in range(4)}})

    bitmaps = [f"b{i}" for i in range(4)]
    columns = ["token", "g", "pos", "lo", "hi", "slack", *bitmaps, "own"]

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of the shingles that the sketch doesn't prove to be rare."""
        for b in batches:
            t = np.concatenate([np.frombuffer(x.as_buffer(), "<u8") for x in b.column(0)] or [np.zeros(0, np.uint64)])
            u, c = np.unique(t[magnitudes.value[t >> _SHIFT] >= block.bit_length()], return_counts=True)
            yield pa.record_batch({"token": pa.array(u.view(np.int64)), "c": pa.array(c, pa.int64())})

    def hot_tokens(m: DataFrame, more: DataFrame | None = None) -> DataFrame:
        """``token, blocks`` of shingles that more than ``BLOCK`` rows of an index have: one for each prefix in ``m``, and the rows of ``more``."""
        c = in_arrow(m.select("prefix"), tally, "token bigint, c bigint")
        if more is not None:
            c = c.unionByName(more.select("token", F.lit(1).cast("long").alias("c")))
        c = c.groupBy("token").agg(F.sum("c").alias("c")).filter(F.col("c") > block)
        return small_or_shuffled(c.select("token", F.ceil(F.col("c") / block).cast("int").alias("blocks")), "hot_tokens", scratch)

    def index(m: DataFrame, part: int = 0, parts: int = 1) -> DataFrame:
        """m: ``g, n, prefix, bits``. One of ``parts`` slices by shingle, a power of two."""
        kinds = "token bigint, g bigint, pos int, lo int, hi int, " + ", ".join(f"{b} bigint" for b in bitmaps)
        return in_arrow(m.select("g", "n", "prefix", "bits"), lambda it: tokens(it, part, parts), kinds)

    def slices(m: DataFrame, hot: DataFrame, more: DataFrame | None = None) -> int:
        """How many slices keep the shuffled rows of an index below ``SLICE_ROWS``, with the copies of hot rows."""
        n = m.agg(F.coalesce(F.sum(F.octet_length("prefix")), F.lit(0))).first()[0] // 8 + (more.count() if more is not None else 0)
        n += block * hot.agg(F.coalesce(F.sum(F.col("blocks").cast("long") * (F.col("blocks") - 1)), F.lit(0))).first()[0]
        return 1 << max(0, -(-n // slice_rows) - 1).bit_length()

    def found_pairs(rows: Callable[[int, int], DataFrame], hot: DataFrame, parts: int, label: str) -> DataFrame:
        """rows: the index, by slice. Each slice's pairs are written, which lets its shuffle files go before the next one's come."""
        each = [materialize(_sliced_pairs(rows(i, parts), hot), label, scratch) for i in range(parts)]
        return each[0] if parts == 1 else materialize(reduce(DataFrame.unionByName, each).distinct(), label, scratch)

    def _sliced_pairs(rows: DataFrame, hot: DataFrame) -> DataFrame:
        """A row of a hot shingle goes to the pairs that its block forms with each block."""
        r = rows.select(columns).join(hot, "token", "left").withColumn("b", F.pmod(F.xxhash64("g"), F.coalesce("blocks", F.lit(1))))
        r = r.withColumn("j", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
        side = F.when(F.col("b") == F.col("j"), 0).when(F.col("b") < F.col("j"), 1).otherwise(2).cast("int").alias("side")
        run = F.when(F.col("blocks").isNull(), F.col("token")).otherwise(F.xxhash64("token", F.least("b", "j"), F.greatest("b", "j"))).alias("run")
        spread = r.select(run, *columns[1:], side).repartition("run").sortWithinPartitions("run")
        return in_arrow(spread, lambda it: _runs(it, percent), "x bigint, y bigint").distinct()

    alone = members.filter("NOT led")
    many = index(members.filter("led")).groupBy("token", "g").agg(F.min("pos").alias("pos"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    many = many.join(groups.select("g", "slack", *[F.get("bits", F.lit(i)).alias(b) for i, b in enumerate(bitmaps)]), "g").withColumn("own", F.col("g"))
    many = materialize(many.select(columns), "group_tokens", scratch)
    hot = hot_tokens(alone, many)

    def of_groups(part: int, parts: int) -> DataFrame:
        one = index(alone, part, parts).withColumns({"slack": F.lit(0).cast("long"), "own": F.col("g")})
        return one.select(columns).unionByName(many.filter(F.col("token").bitwiseAND(F.lit(parts - 1)) == part))

    pairs = found_pairs(of_groups, hot, slices(alone, hot, many), "group_pairs")

    # The leaders' exact distance decides, or leaves the pair open for its members.
    limit = (100 - percent) / 100
    radius = groups.select(F.col("g").alias("x"), F.col("r").alias("rx"))
    near = similarities(pairs, docs, same, repeated, k, scratch).withColumn("d", 1 - F.col("both") / F.col("either"))
    near = near.join(radius, "x", "left").join(radius.select(F.col("x").alias("y"), F.col("rx").alias("ry")), "y", "left").na.fill(0.0, ["rx", "ry"])
    linked = F.col("both") * 100 >= F.col("either") * percent
    near = materialize(near.filter(linked | ((F.col("rx") + F.col("ry") > 0) & (F.col("d") <= limit + F.col("rx") + F.col("ry") + 1e-9))).withColumn("linked", linked), "near", scratch)
    # The least node of a component is then one with its smallest id.
    ends = [F.struct(F.col(i).alias("id"), F.col(x).alias("node")).alias(u) for i, x, u in (("ix", "x", "u"), ("iy", "y", "v"))]
    links = led.select(ends).unionByName(near.filter("linked").select(ends))
    found = components(links, scratch)

    open_pairs = _apart(near.filter("NOT linked").select("x", "y", "d"), found, scratch)
    if open_pairs.limit(1).count():
        both = F.explode(F.array("x", "y")).alias("g")
        m = materialize(members.join(open_pairs.select(both).distinct(), "g", "left_semi"), "open_members", scratch)
        of = m.select("node", "g")
        hot = hot_tokens(m)

        def of_members(part: int, parts: int) -> DataFrame:
            each = index(m.select(F.col("node").alias("g"), "n", "prefix", "bits"), part, parts).withColumn("slack", F.lit(0).cast("long"))
            return each.join(of.select(F.col("node").alias("g"), F.col("g").alias("own")), "g")

        near_members = found_pairs(of_members, hot, slices(m, hot), "member_pairs")
        named = near_members.join(of.select(F.col("node").alias("x"), F.col("g").alias("gx")), "x").join(of.select(F.col("node").alias("y"), F.col("g").alias("gy")), "y")
        opened = open_pairs.select(F.least("x", "y").alias("ga"), F.greatest("x", "y").alias("gb"))
        wide = named.withColumns({"ga": F.least("gx", "gy"), "gb": F.greatest("gx", "gy")}).join(opened, ["ga", "gb"], "left_semi")
        wide = materialize(wide.select("x", "y"), "expanded", scratch)
        more = similarities(wide, docs, same, repeated, k, scratch).filter(linked).select(ends)
        found = components(found.select("u", F.col("component").alias("v")).unionByName(more), scratch)

    component = found.select(F.col("u.node").alias("node"), F.col("component.id").alias("c"), F.col("component.node").alias("root"))
    # Written out, so that both sides of the last join are shuffled and its skew can be split.
    of_set = materialize(same.join(component, "node", "left").select("node", F.coalesce("c", "id").alias("c"), F.coalesce("root", "node").alias("root")), "components", kept)
    scratch.clear()
    return rows.select("id", "h", "n", "node").join(of_set, "node", "left").select("id", "h", "n", F.coalesce("c", "id").alias("c"), "node", "root")


def _apart(pairs: DataFrame, found: DataFrame, scratch: Scratch) -> DataFrame:
    """The pairs whose ends aren't in one component yet."""
    c = found.select(F.col("u.node").alias("x"), F.col("component.node").alias("cx"))
    p = pairs.join(c, "x", "left").join(c.select(F.col("x").alias("y"), F.col("cx").alias("cy")), "y", "left")
    return materialize(p.filter(F.coalesce("cx", "x") != F.coalesce("cy", "y")).select("x", "y", "d"), "open_pairs", scratch)


def _known(id_col: Column) -> Column:
    return F.coalesce(id_col.cast("long"), F.lit(2**63 - 1))


def keep_first(docs: DataFrame, k: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of documents that links connect, with all its columns: one with the smallest id, whose set names the component.

    A row without an id is kept only where no row of its group has one. Of rows that are equal in id and text any one stays, of several texts of the
    smallest id with equal sets the one with the least hash. Documents without words link with nothing, so all of them stay.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    found = _linked(docs, k, percent, id_col, text_col, scratch).filter("n > 0")
    each = materialize(found.groupBy("id", "h", ((F.col("id") == F.col("c")) & (F.col("node") == F.col("root"))).alias("named"), "root").agg(F.count("*").alias("copies")), "rows_of_groups", scratch)
    firsts = each.filter("named").groupBy("root").agg(F.min(F.struct("h", "id", "copies")).alias("m"), F.count("*").alias("texts"))
    more = each.filter("named").join(firsts.filter("texts > 1").select("root", F.col("m.h").alias("_h")), "root").filter(F.col("h") > F.col("_h"))
    gone = each.filter("NOT named").select("id", "h").unionByName(more.select("id", "h")).select(F.col("id").alias("gone_id"), F.col("h").alias("gone_h"))
    many = firsts.filter("m.copies > 1").select(F.col("m.id").alias("gone_id"), F.col("m.h").alias("gone_h"))
    # The rows that have equals go as well, and one of them comes back.
    gone, many = small_or_shuffled(gone.unionByName(many), "near_copies"), small_or_shuffled(many, "repeated_rows")
    scratch.clear()

    def same_row(other: DataFrame) -> Column:
        return (_known(docs[id_col]) == other["gone_id"]) & (F.xxhash64(docs[text_col]) == other["gone_h"])

    kept = docs.join(gone, same_row(gone), "left_anti").select(docs.columns)
    if many.isEmpty():
        return kept
    names = [f"_c{i}" for i in range(len(docs.columns))]  # whatever the columns are called, they don't clash with the group's
    rows = docs.join(many, same_row(many), "left_semi").select(_known(docs[id_col]).alias("_id"), F.xxhash64(docs[text_col]).alias("_h"), F.struct(*[docs[c].alias(n) for c, n in zip(docs.columns, names)]).alias("_row"))
    one = rows.groupBy("_id", "_h").agg(F.first("_row").alias("_row")).select(*[F.col(f"_row.{n}").alias(c) for c, n in zip(docs.columns, names)])
    return kept.unionByName(one)
