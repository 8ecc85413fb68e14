"""N-gram Jaccard join by size: subsets of small sets, inverted lists for large ones.

A document's set holds its distinct word shingles.  Two sets of similarity of
at least 4/5 overlap so far that their prefixes, in any order common to all
sets, share shingles.  Small sets enumerate the 2-subsets of their (longer)
prefix as keys; large sets, and the small ones that may match them, post the
shingles of their prefix to inverted lists, which are scanned.  The boundary
between small and large is the one of least estimated cost.

Shingles that many documents share come last in the order, so their lists stay
short.  Sets are compared once however many documents have them.  Lists first
propose links to one hub each; members that verified links have joined are not
proposed again, so a group of near copies costs one comparison per member and
not one per pair.  A list beyond ``LIST_BLOCK`` members proposes in blocks that
share their hub where sizes allow; what its links leave apart from its largest class, and only
that, is then compared with the whole list, block by block.  Every proposed
pair is verified on whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm import runtime, wordhash
from cairn.llm.components import connected_components
from cairn.llm.scratch import Scratch

SHINGLE_WORDS = 5
#: Similarity: SIMILAR[0] * union <= SIMILAR[1] * intersection.
SIMILAR = (4, 5)
#: Shingles that sort last: a shingle counts locally from this many documents of a block of shingles.
FREQUENT_IN_BLOCK = 4
BLOCK_SHINGLES = 1 << 21
#: Most frequent shingles that the order knows; an unknown one merely sorts among the rest.
ORDERED_SHINGLES = 50_000
#: Largest size that may count as small; subsets grow with the square of the prefix.
MOST_SMALL = 60
#: Members of one list that are compared in one task; longer lists are cut into blocks.
LIST_BLOCK = 512
#: Sizes are put into bands of this ratio: similar sets are in one band or in neighbouring ones.
BAND = 1.3
#: Members that one hub is compared with in one task.
HUB_CHUNK = 512


def least_overlap(size: int | np.ndarray) -> int | np.ndarray:
    """Shingles that a set shares with any similar set, at least."""
    return -(-SIMILAR[0] * size // SIMILAR[1])


def prefix_length(size, keys: int = 1):
    """Length of the prefix in which similar sets share ``keys`` shingles."""
    return size - least_overlap(size) + keys


def subset_count(size):
    """2-subsets of a small set's prefix (a set of one shingle has that one)."""
    p = prefix_length(size, 2)
    return np.where(np.asarray(size) < 2, np.asarray(size), p * (p - 1) // 2)


# --- frequent shingles and sizes -------------------------------------------


@dataclass
class Order:
    """Frequent shingles (sorted), their ranks, and the largest small size."""

    shingles: np.ndarray
    ranks: np.ndarray
    small: int
    _mask: np.ndarray | None = None

    def rank(self, h: np.ndarray) -> np.ndarray:
        """0 for shingles that are not known to be frequent, else 1 and up by frequency."""
        out = np.zeros(len(h), dtype=np.int64)
        if not len(self.shingles):
            return out
        if self._mask is None:
            self._mask = np.zeros(1 << 20, dtype=bool)
            self._mask[(self.shingles & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        maybe = np.flatnonzero(self._mask[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
        at = np.searchsorted(self.shingles, h[maybe])
        at[at == len(self.shingles)] = 0
        hit = self.shingles[at] == h[maybe]
        out[maybe[hit]] = self.ranks[at[hit]]
        return out


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Locally frequent shingles (kind 0), sets by size (kind 1, sizes up to 2 * MOST_SMALL), and all shingles (kind 2)."""
    schema = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("n", pa.int64())])
    sizes, total = np.zeros(2 * MOST_SMALL + 1, dtype=np.int64), 0
    held: list[np.ndarray] = []

    def frequent() -> Iterator[pa.RecordBatch]:
        if held:
            h, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            pick = n >= FREQUENT_IN_BLOCK
            yield runtime.batch(schema, kind=np.zeros(pick.sum(), np.int32), key=wordhash.as_long(h[pick]), n=n[pick])

    for b in batches:
        for block in wordhash.blocks(b.column("text")):
            h, at = wordhash.ngram_sets(block, SHINGLE_WORDS)
            held.append(h)
            total += len(h)
            sizes += np.bincount(np.minimum(np.diff(at), len(sizes) - 1), minlength=len(sizes))
            if sum(map(len, held)) >= BLOCK_SHINGLES:
                yield from frequent()
    yield from frequent()
    seen = np.flatnonzero(sizes)
    yield runtime.batch(schema, kind=np.ones(len(seen), np.int32), key=seen, n=sizes[seen])
    yield runtime.batch(schema, kind=[2], key=[0], n=[total])


def boundary(sets_by_size: dict[int, int], met_by_one: float, met_by_two: float) -> int:
    """The largest size that is small, of least cost.

    A key costs its row and the other sets that scanning its list meets:
    ``met_by_one`` on average for a shingle, ``met_by_two`` for a subset of two.
    Small sets of more than 4/5 of the boundary post to inverted lists as well.
    """
    def cost(small: int) -> float:
        total = 0.0
        for size, n in sets_by_size.items():
            if 0 < size <= small:
                total += n * float(subset_count(size)) * (1 + met_by_two)
            if size > 0 and SIMILAR[1] * size > SIMILAR[0] * small:
                total += n * float(prefix_length(size)) * (1 + met_by_one)
        return total

    return min(range(MOST_SMALL + 1), key=lambda s: (cost(s), s))


def survey(docs: DataFrame, scratch: Scratch) -> Order:
    """Order and boundary from counts over all documents (columns doc_id, text)."""
    found = scratch.cut(
        docs.select("text").mapInArrow(_survey, "kind int, key long, n long").groupBy("kind", "key").agg(
            F.sum("n").alias("n")), "survey")
    frequent = found.where("kind = 0")
    # how many shingles have about each count; then the least count whose shingles are few enough
    bins = sorted(frequent.groupBy(F.floor(F.log2("n") * 8).alias("bin")).agg(
        F.count("*").alias("shingles"), F.min("n").alias("least"), F.max("n").alias("most")).collect(), key=lambda r: -r.bin)
    admitted, left = F.lit(False), ORDERED_SHINGLES
    for r in bins:
        if r.shingles > left:  # of the bin that does not fit, a share by hash
            share = int(-(2**63) + left / r.shingles * 2**64)
            admitted |= F.col("n").between(r.least, r.most) & (F.col("key") <= min(share, 2**63 - 1))
            break
        admitted |= F.col("n").between(r.least, r.most)
        left -= r.shingles
    top = frequent.where(admitted).collect()  # about ORDERED_SHINGLES rows at most
    top.sort(key=lambda r: (r.n, r.key))
    sizes = {r.key: r.n for r in found.where("kind = 1").collect()}
    shingles = found.where("kind = 2").agg(F.sum("n")).first()[0] or 0
    scratch.drop(found)
    key = wordhash.as_hash(np.array([r.key for r in top], dtype=np.int64))
    rank = np.arange(1, len(top) + 1)  # the most frequent last
    order = np.argsort(key)
    # a shingle meets the others of its count; a subset of two only where its second shingle is repeated as well
    met = sum(r.n * (r.n - 1) for r in top) / max(1, shingles)
    repeated = sum(r.n for r in top) / max(1, shingles)
    return Order(key[order], rank[order], boundary(sizes, met, met * repeated))


# --- signatures ------------------------------------------------------------

SIGNATURE = "doc_id long, size int, set1 long, set2 long, sketch binary, front int, keys array<long>"
_SIGNATURE_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("size", pa.int32()), ("set1", pa.int64()), ("set2", pa.int64()),
    ("sketch", pa.binary()), ("front", pa.int32()), ("keys", pa.list_(pa.int64()))])


def sketch_bits(size: int) -> int:
    return max(64, 1 << int(size - 1).bit_length()) if size > 1 else 64


def _sketch(h: np.ndarray) -> bytes:
    """Parity of shingles by bucket: sets that differ in d shingles differ in d bits at most."""
    bits = sketch_bits(len(h))
    parity = np.bincount((h & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()


def _keys(h: np.ndarray, order: Order) -> tuple[np.ndarray, int]:
    """Keys of one set in the common order, and how many lead (see ``signatures``)."""
    size, out = len(h), []
    p1 = int(prefix_length(size))
    if size <= order.small:
        if size == 1:
            out.append(wordhash.mix(h ^ np.uint64(0x53)))
        else:
            head = h[: int(prefix_length(size, 2))]
            i, j = np.triu_indices(len(head), 1)
            pair = np.minimum(head[i], head[j]) * np.uint64(0x9E3779B97F4A7C15) + np.maximum(head[i], head[j])
            out.append(wordhash.mix(pair))
    front = sum(map(len, out))
    if SIMILAR[1] * size > SIMILAR[0] * order.small:
        out.append(h[:p1])
        # the shorter of a pair overlaps it by 8/9 of itself, so its share of the prefix is shorter
        front += size - (-(-8 * size // 9)) + 1
    return np.concatenate(out), front


def signatures(docs: DataFrame, order: Order) -> DataFrame:
    """One row per document: set size, 128-bit set identity, sketch and keys.

    The first ``front`` keys make a list worth scanning; a list in which all
    members have only later keys cannot show a new pair.
    """
    shared = docs.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in batches:
            doc_ids = b.column("doc_id").cast(pa.int64())
            for block in wordhash.blocks(b.column("text")):
                h, at = wordhash.ngram_sets(block, SHINGLE_WORDS)
                rank = known.rank(h)
                busy = np.add.reduceat(rank, at[:-1][np.diff(at) > 0]) if len(h) else rank[:0]
                late = np.zeros(block.n_docs, dtype=bool)
                late[np.flatnonzero(np.diff(at))] = busy > 0
                rows: dict[str, list] = {n: [] for n in _SIGNATURE_ARROW.names}
                for d in range(block.n_docs):
                    own = h[at[d] : at[d + 1]]
                    one = two = 0
                    sketch, keys, front = None, own.view(np.int64), 0
                    if len(own):
                        mark = xxhash.xxh3_128_digest(own.tobytes())
                        one, two = (int.from_bytes(mark[k : k + 8], "little", signed=True) for k in (0, 8))
                        sketch = _sketch(own)
                        if late[d]:
                            own = own[np.argsort(rank[at[d] : at[d + 1]], kind="stable")]
                        keys, front = _keys(own, known)
                        keys = keys.view(np.int64)
                    for name, value in zip(rows, (None, len(own), one, two, sketch, front, keys)):
                        rows[name].append(value)
                rows["doc_id"] = doc_ids.slice(block.first, block.n_docs)
                yield runtime.batch(_SIGNATURE_ARROW, **rows)

    return docs.mapInArrow(run, SIGNATURE)


# --- lists -----------------------------------------------------------------


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of two or more sets, from rows sorted by key; equal lists leave a task once.

    A list that has several blocks gives one row for each (``blocks`` tells how many).
    """
    schema = pa.schema([("list1", pa.int64()), ("list2", pa.int64()), ("blocks", pa.int32()), ("block", pa.int32()),
                        ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32()))])
    seen: set[bytes] = set()
    for t, at in runtime.sorted_runs(batches, ["key"]):
        many = np.flatnonzero(np.diff(at) > 1)
        ids, sizes, front = (t.column(c).to_numpy() for c in ("doc_id", "size", "front"))
        rows: dict[str, list] = {n: [] for n in schema.names}
        for k in many:
            own = slice(at[k], at[k + 1])
            if not front[own].any():
                continue
            order = np.lexsort((ids[own], sizes[own]))
            own_ids, own_sizes = ids[own][order], sizes[own][order]
            mark = xxhash.xxh3_128_digest(own_ids.tobytes())
            if mark in seen:
                continue
            if len(seen) > 200_000:
                seen.clear()
            seen.add(mark)
            one, two = (int.from_bytes(mark[i : i + 8], "little", signed=True) for i in (0, 8))
            parts = _blocks(own_ids, own_sizes)
            for block, part in enumerate(parts):
                for name, value in zip(rows, (one, two, len(parts), block, own_ids[part], own_sizes[part])):
                    rows[name].append(value)
        if rows["ids"]:
            yield runtime.batch(schema, **rows)


def _blocks(ids: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """The members of a list's blocks, sorted by size.

    A block holds the first member of the next one, and the member of least id of all whose sizes can match the
    block's, so that what the whole list has in common finds one hub.
    """
    n = len(ids)
    if n <= LIST_BLOCK:
        return [np.arange(n)]
    out = []
    for a in range(0, n - 1, LIST_BLOCK):
        own = np.arange(a, min(n, a + LIST_BLOCK + 1))
        lo = np.searchsorted(SIMILAR[1] * sizes, SIMILAR[0] * sizes[own[0]])
        hi = np.searchsorted(SIMILAR[0] * sizes, SIMILAR[1] * sizes[own[-1]], side="right")
        out.append(np.union1d(own, lo + np.argmin(ids[lo:hi])))
    return out


def _hub_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each list, links of its members to hubs: a member goes to the first hub that it can match by size."""
    schema = pa.schema([("x", pa.int64()), ("y", pa.int64())])
    for b in batches:
        xs, ys = [], []
        for ids, sizes in zip(b.column("ids"), b.column("sizes")):
            i, s = ids.values.to_numpy(), sizes.values.to_numpy()
            hub = 0
            while hub < len(i) - 1:
                end = int(np.searchsorted(s, s[hub] * SIMILAR[1] // SIMILAR[0], side="right"))
                # of the members that the smallest can match, the one of least id is the hub
                best = hub + int(np.argmin(i[hub:end]))
                others = np.delete(np.arange(hub, end), best - hub)
                others = others[SIMILAR[1] * np.minimum(s[others], s[best]) >= SIMILAR[0] * np.maximum(s[others], s[best])]
                xs.append(np.full(len(others), i[best]))
                ys.append(i[others])
                hub = max(end, hub + 1)
        if xs:
            x, y = np.concatenate(xs), np.concatenate(ys)
            code = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1), axis=0)
            yield runtime.batch(schema, x=np.ascontiguousarray(code[:, 0]), y=np.ascontiguousarray(code[:, 1]))


def _plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches allow similarity: similar sets of sizes a and b differ in at most (a + b) / 9 shingles."""
    for b in batches:
        left, right = b.column("sketch").to_pylist(), b.column("other").to_pylist()
        limit = b.column("size").to_numpy().astype(np.int64) + b.column("other_size").to_numpy()
        widths = np.array([(len(a), len(c)) for a, c in zip(left, right)], dtype=np.int64).reshape(-1, 2)
        keep = np.zeros(b.num_rows, dtype=bool)
        for w in np.unique(widths, axis=0):
            rows = np.flatnonzero((widths == w).all(axis=1))
            least = int(w.min()) // 8
            sides = [np.frombuffer(b"".join([side[i] for i in rows]), np.uint64).reshape(len(rows), -1) for side in (left, right)]
            sides = [_folded(x, least) for x in sides]
            keep[rows] = 9 * np.bitwise_count(sides[0] ^ sides[1]).sum(axis=1).astype(np.int64) <= limit[rows]
        yield b.select(["x", "y"]).filter(pa.array(keep))


def _open_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of members that no links have joined and whose sizes and sketches allow similarity.

    Rows come sorted by ``part``.  A part's members of side 1 are compared with those of side 0 only.
    """
    schema = pa.schema([("x", pa.int64()), ("y", pa.int64())])
    for t, at in runtime.sorted_runs(batches, ["part1", "part2"]):
        ids, sizes, component, sides = (t.column(c).to_numpy() for c in ("doc_id", "size", "component", "side"))
        raw = t.column("sketch").to_pylist()
        xs, ys = [], []
        for a, b in zip(at[:-1], at[1:]):
            if (component[a:b] == component[a]).all():
                continue
            order = a + np.argsort(sizes[a:b], kind="stable")
            s, c, side = sizes[order].astype(np.int64), component[order], sides[order]
            for bits in sorted({len(raw[k]) for k in order}):  # sketches of one width at a time
                width = bits // 8
                here = np.flatnonzero([len(raw[k]) in (bits, 2 * bits) for k in order])
                words = np.concatenate([_folded(np.frombuffer(raw[k], np.uint64)[None, :], width) for k in order[here]])
                exact = np.array([len(raw[k]) == bits for k in order[here]])
                for m in np.flatnonzero(exact):
                    near = (SIMILAR[1] * np.minimum(s[here], s[here[m]]) >= SIMILAR[0] * np.maximum(s[here], s[here[m]]))
                    near &= (c[here] != c[here[m]]) & (side[here] + side[here[m]] < 2)
                    near[: m + 1] &= ~exact[: m + 1]
                    cand = np.flatnonzero(near)
                    if len(cand):
                        apart = np.bitwise_count(words[cand] ^ words[m]).sum(axis=1)
                        # similar sets of sizes a and b differ in at most (a + b) / 9 shingles
                        cand = cand[9 * apart.astype(np.int64) <= s[here[cand]] + s[here[m]]]
                        u, v = ids[order[here[m]]], ids[order[here[cand]]]
                        xs.append(np.minimum(u, v))
                        ys.append(np.maximum(u, v))
        if xs:
            yield runtime.batch(schema, x=np.concatenate(xs), y=np.concatenate(ys))


def _folded(words: np.ndarray, width: int) -> np.ndarray:
    """Sketches (rows of 64-bit words) brought to a smaller width, at which they are what a smaller set's would be."""
    while words.shape[1] > width:
        half = words.shape[1] // 2
        words = words[:, :half] ^ words[:, half:]
    return words


# --- verification ----------------------------------------------------------


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and SIMILAR[1] * both >= SIMILAR[0] * (len(a) + len(b) - both)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Similar pairs of each hub's chunk: rows sorted so that the hub's texts (one but for repeated ids) precede its members'."""
    schema = pa.schema([("src", pa.int64()), ("dst", pa.int64())])
    hub, of_hub = None, []
    for b in batches:
        keys = list(zip(b.column("x").to_pylist(), b.column("chunk").to_pylist()))
        roles, members = b.column("role").to_pylist(), b.column("y").to_pylist()
        src, dst = [], []
        for block in wordhash.blocks(b.column("text")):
            h, at = wordhash.ngram_sets(block, SHINGLE_WORDS)
            for d in range(block.n_docs):
                own, i = h[at[d] : at[d + 1]], block.first + d
                if roles[i] == 0:
                    of_hub = [*of_hub, own] if hub == keys[i] else [own]
                    hub = keys[i]
                elif hub == keys[i] and any(_similar(h, own) for h in of_hub):
                    src.append(keys[i][0])
                    dst.append(members[i])
        if src:
            yield runtime.batch(schema, src=src, dst=dst)


def _texts_of(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The texts that pairs name."""
    named = pairs.select(F.col("x").alias("doc_id")).union(pairs.select("y")).distinct()
    return texts.join(named, "doc_id", "left_semi")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (x, y) whose whole texts are similar, as (src, dst)."""
    n = runtime.partitions_for(pairs.sparkSession)
    placed = pairs.join(
        pairs.groupBy("x").agg(F.ceil(F.count("*") / HUB_CHUNK).alias("_chunks")), "x"
    ).select("x", "y", F.pmod(F.xxhash64("y"), F.col("_chunks")).alias("chunk"))
    wanted = placed.select(F.col("y").alias("doc_id"), "x", "chunk", F.lit(1).alias("role"), "y").unionByName(
        placed.select("x", "chunk").distinct().select(
            F.col("x").alias("doc_id"), "x", "chunk", F.lit(0).alias("role"), F.col("x").alias("y")))
    return (
        wanted.join(texts, "doc_id").select("x", "chunk", "role", "y", "text")
        .repartition(n, "x", "chunk").sortWithinPartitions("x", "chunk", "role", "y")
        .mapInArrow(_verify, "src long, dst long")
    )


# --- the join --------------------------------------------------------------


def _of_one_id(full: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between an id and the documents that stand for its sets, where it has several."""
    several = full.groupBy("doc_id").agg(
        F.min(F.struct("set1", "set2")).alias("a"), F.max(F.struct("set1", "set2")).alias("b")).where("a <> b").select("doc_id")
    return full.join(several, "doc_id", "left_semi").join(sets, ["set1", "set2"]).where("rep <> doc_id").select(
        F.col("rep").alias("src"), F.col("doc_id").alias("dst")).distinct()


def _parts_of_long_lists(members: DataFrame) -> DataFrame:
    """Members of long lists that links have not made one class, dealt to parts that are compared.

    A list's largest class needs no comparison with itself.  The other members
    are cut into blocks by size band and hash, and each such block (side 0)
    meets itself and every block of its list (side 1) in a band beside its own.
    """
    of_list = ["list1", "list2"]
    largest = members.groupBy(*of_list, "component").count().groupBy(*of_list).agg(
        F.max_by("component", F.struct("count", "component")).alias("largest"))
    banded = members.join(largest, of_list).select(
        *of_list, "doc_id", "size", "component", "sketch", (F.col("component") != F.col("largest")).cast("int").alias("minor"),
        F.floor(F.log(F.col("size")) / F.log(F.lit(BAND))).cast("int").alias("band"))
    counts = banded.groupBy(*of_list, "band", "minor").agg(F.ceil(F.count("*") / LIST_BLOCK).cast("int").alias("blocks"))
    placed = banded.join(counts, [*of_list, "band", "minor"]).withColumn(
        "block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")).drop("blocks")
    blocks = counts.select(*of_list, "band", "minor", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    left = blocks.where("minor = 1").select(*of_list, F.col("band").alias("band0"), F.col("block").alias("block0"))
    right = blocks.select(*of_list, *(F.col(c).alias(f"{c}1") for c in ("band", "minor", "block")))
    # two blocks of minor members meet once, from the lower one
    met = left.join(right, of_list).where(
        (F.abs(F.col("band0") - F.col("band1")) <= 1)
        & ((F.col("minor1") == 0) | (F.struct("band0", "block0") <= F.struct(F.col("band1").alias("band0"), F.col("block1").alias("block0"))))
    ).withColumn("itself", (F.col("minor1") == 1) & (F.col("band0") == F.col("band1")) & (F.col("block0") == F.col("block1")))
    name = [F.xxhash64(*of_list, "band0", "block0", "band1", "minor1", "block1", F.lit(k)).alias(f"part{k}") for k in (1, 2)]
    met = met.select(*of_list, *name, "band0", "block0", "band1", "minor1", "block1", "itself")
    sides = met.select(*of_list, "part1", "part2", F.lit(0).alias("side"), F.col("band0").alias("band"), F.lit(1).alias("minor"),
                       F.col("block0").alias("block")).unionByName(
        met.where("NOT itself").select(*of_list, "part1", "part2", F.lit(1).alias("side"), F.col("band1").alias("band"),
                                       F.col("minor1").alias("minor"), F.col("block1").alias("block")))
    return placed.join(sides, [*of_list, "band", "minor", "block"]).select(
        "part1", "part2", "side", "doc_id", "size", "component", "sketch")


def similarity_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    Documents are linked where the Jaccard similarity of their sets of 5-word
    shingles (A-Z lower-cased; fewer words: the whole sequence as one shingle)
    is at least 0.8; component_id is the smallest id that links reach.  Null,
    empty and wordless texts have no shingle and link with nothing.  Rows that
    repeat an id are one document with several texts, which links what any of
    them links; each is returned with its own set size.  A row without id is
    returned with null component.  An empty table gives none; other columns are
    not read.
    """
    spark = docs.sparkSession
    runtime.prepare(spark)
    scratch = Scratch(spark, "ngrams")
    n = runtime.partitions_for(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = scratch.cut(signatures(texts, survey(texts, scratch)), "signatures")
    full = signed.where("size > 0 AND doc_id IS NOT NULL")
    sets = scratch.cut(full.groupBy("set1", "set2").agg(F.min("doc_id").alias("rep")), "sets")

    postings = full.join(sets.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").select(
        "doc_id", "size", "front", F.posexplode("keys").alias("pos", "key")).select(
        "key", "doc_id", "size", (F.col("pos") < F.col("front")).cast("int").alias("front"))
    lists = scratch.cut(
        postings.repartition(n, "key").sortWithinPartitions("key")
        .mapInArrow(_lists, "list1 long, list2 long, blocks int, block int, ids array<long>, sizes array<int>")
        .dropDuplicates(["list1", "list2", "block"]), "lists")

    sketches = full.select("doc_id", "size", "sketch")
    other = sketches.toDF("y", "other_size", "other")
    hubs = scratch.cut(
        lists.select("ids", "sizes").mapInArrow(_hub_pairs, "x long, y long").where("x <> y").distinct()
        .join(sketches.withColumnRenamed("doc_id", "x"), "x").join(other, "y")
        .select("x", "y", "size", "other_size", "sketch", "other").mapInArrow(_plausible, "x long, y long"), "hubs")
    links = scratch.cut(_verified(hubs, _texts_of(hubs, texts.hint("merge"))).unionByName(_of_one_id(full, sets)), "links")
    joined = connected_components(links, scratch)

    members = lists.where("blocks > 1 OR size(ids) > 2").select("list1", "list2", "blocks", F.explode("ids").alias("doc_id"))
    described = members.join(joined.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "list1", "list2", "blocks", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    unsettled = described.groupBy("list1", "list2").agg(
        F.min("component").alias("_a"), F.max("component").alias("_b")).where("_a <> _b").select("list1", "list2")
    apart = described.join(unsettled, ["list1", "list2"], "left_semi").join(sketches, "doc_id")
    short = apart.where("blocks = 1").select(
        F.col("list1").alias("part1"), F.col("list2").alias("part2"), F.lit(0).alias("side"), "doc_id", "size", "component", "sketch")
    long = scratch.cut(apart.where("blocks > 1").drop("blocks").dropDuplicates(["list1", "list2", "doc_id", "size", "sketch"]), "long")
    rest = (
        short.unionByName(_parts_of_long_lists(long))
        .repartition(n, "part1", "part2").sortWithinPartitions("part1", "part2")
        .mapInArrow(_open_pairs, "x long, y long").where("x <> y").distinct()
        .join(hubs, ["x", "y"], "left_anti")
    )
    rest = scratch.cut(rest, "rest")
    if not rest.isEmpty():
        more = scratch.cut(_verified(rest, _texts_of(rest, texts)), "more")
        joined = connected_components(links.unionByName(more), scratch)
    scratch.drop(lists, long)

    of_set = sets.join(joined.withColumnRenamed("node", "rep"), "rep", "left").select(
        "set1", "set2", F.coalesce("component", "rep").alias("component"))
    return signed.select("doc_id", "size", "set1", "set2").join(
        of_set, ["set1", "set2"], "left").select(
        "doc_id", F.col("size").cast("long").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull() & (F.col("size") > 0), F.coalesce("component", "doc_id"))
        .otherwise(F.col("doc_id")).alias("component_id"))
