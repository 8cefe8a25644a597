"""Near-duplicate documents: fast similarity sketches, banding, exact verification, components.

A document's set holds its distinct 4-word shingles (the whole sequence where it has fewer words).
Documents link where intersection and union satisfy 100 * |A & B| >= 80 * |A | B|.

1. Equal sets form a class at once, by a 128-bit digest of the sorted set, which names the node from then on, so
   that thousands of copies are one node. One row of a class, known by doc_id and its text's digest, gives the text.
2. A sketch has 128 coordinates, filled in rounds. A round throws every shingle into one bin by a hash
   of its own; a bin keeps the smallest value of the first round that reaches it. From round 128 on a
   round serves one bin only, so after 256 rounds at most no coordinate of a non-empty set is empty.
   Small sets need more rounds, large ones one or two.
3. 32 bands of 4 coordinates make candidates. At a similarity of 0.8 a pair misses all bands with a
   chance of (1 - 0.8 ** 4) ** 32 = 5e-8.
4. First every member of a bucket is compared with the smallest member; links that hold on the full sets
   give first components. A bucket that still holds more than one component, and more than two
   members, is compared throughout: in blocks of bounded size, between different components only,
   first by sketch and then on the full sets. Thus no bucket is capped, and no group emits all its
   pairs: only links leave a block, and one link between two components at most.

Texts are moved only where they may be needed. A sieve marks the rows asked for by a hash in a broadcast of at most
``SLOTS`` rows; rows that miss it stay where they are read, all others are joined by their exact keys. Members of buckets
that nobody shares are left out after one count of narrow rows, and both searches for links read the stored rest.

Full sets are recomputed from texts where they are compared, never collected. Null and empty texts and
texts without words have an empty set and link with nothing. Rows are documents: each has its own set, also where rows
repeat a doc_id, and rows with a null doc_id link like others. A component is named by its smallest doc_id, which is null only
if all its rows have none. ``deduplicate`` keeps one row of each component, that of the smallest doc_id, null last, then of the
smallest text digest; of rows alike in both, the one whose hash of all columns is smallest. Extra columns pass through it,
whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tierlake import scratch
from tierlake.llm import text as T
from tierlake.llm.components import components
from tierlake.operators.joins import fair_share, spread_left_join

WIDTH = 4
COORDINATES, BANDS = 128, 32
# Members of one block when a bucket is compared throughout, and guests that one task compares with them.
BLOCK, GUESTS = 256, 4096
# Six standard deviations of a 128-coordinate estimate below the similarity of 0.8.
LEAST_AGREEMENT = 76
# Slots of a sieve, with 64 marks each; a table that fills them only moves more texts.
SLOTS = 1 << 18
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    words = T.Words(data, offsets)
    h = words.hashes()
    if len(h) == 0:
        return [h] * (len(offsets) - 1)
    padded = np.concatenate([h, np.zeros(WIDTH, np.uint64)])
    whole = sum((padded[k : k + len(h)] * _ODD[k] for k in range(WIDTH)), np.zeros(len(h), np.uint64))
    whole = T.mix(whole)
    found = []
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        if b - a >= WIDTH:
            found.append(np.unique(whole[a : b - WIDTH + 1]))
        elif b > a:
            found.append(T.mix(np.array([(h[a:b] * _ODD[: b - a]).sum() + np.uint64(b - a)], np.uint64)))
        else:
            found.append(h[:0])
    return found


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """One row of coordinates for each set, of 16 bits each; rows of empty sets are zero."""
    sizes = np.array([len(s) for s in sets])
    filled = np.full((len(sets), COORDINATES), _EMPTY)
    elements, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    for turn in range(2 * COORDINATES):
        if len(elements) == 0:
            break
        x = T.mix(elements ^ T.mix(np.array([turn + 1], np.uint64) * _ODD[1]))
        if turn < COORDINATES:
            place = owner * COORDINATES + (x & np.uint64(COORDINATES - 1)).astype(np.int64)
        else:
            place = owner * COORDINATES + (turn - COORDINATES)
        reached = np.full(filled.size, _EMPTY)
        np.minimum.at(reached, place, x >> np.uint64(7))
        filled = np.where(filled == _EMPTY, reached.reshape(filled.shape), filled)
        open_rows = (filled == _EMPTY).any(axis=1)
        go_on = open_rows[owner]
        elements, owner = elements[go_on], owner[go_on]
    short = (T.mix(filled) & np.uint64(0xFFFF)).astype("<u2")
    short[sizes == 0] = 0
    return short


SKETCHED = "doc_id bigint, key binary, n_shingles bigint, digest binary, sketch array<bigint>"


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, keys = T.column(batch, "doc_id"), T.column(batch, "key")
        for row, end, data, offsets in T.slices(T.column(batch, "text")):
            sets = shingle_sets(data, offsets)
            short = sketches(sets)
            bands = np.ascontiguousarray(short).view("<i8").reshape(-1)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(row, end - row),
                    keys.slice(row, end - row),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(np.arange(0, len(bands) + 1, BANDS, dtype=np.int32), pa.array(bands)),
                ],
                ["doc_id", "key", "n_shingles", "digest", "sketch"],
            )


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of candidate pairs with both texts, those that link on their full sets."""
    for batch in batches:
        a, b = (T.column(batch, name).to_pylist() for name in ("a", "b"))
        kept = []
        left, right = T.column(batch, "text_a"), T.column(batch, "text_b")
        last, of_last = None, None
        for row in range(len(a)):
            if a[row] != last:
                last, of_last = a[row], _one_set(left[row].as_py())
            other = _one_set(right[row].as_py())
            both = len(np.intersect1d(of_last, other, assume_unique=True))
            kept.append(100 * both >= 80 * (len(of_last) + len(other) - both))
        keep = pa.array(kept, pa.bool_())
        yield pa.RecordBatch.from_arrays([T.column(batch, "a").filter(keep), T.column(batch, "b").filter(keep)], ["a", "b"])


def _one_set(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return shingle_sets(data, np.array([0, len(data)]))[0]


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the text's digest; a null text counts as empty."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("key", _text_key())


def _text_key() -> Column:
    return F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")))


def _slot_and_mark(doc_id: str, key: str) -> tuple[Column, Column]:
    place = F.xxhash64(doc_id, key)
    bit = F.pmod(F.shiftright(place, 32), F.lit(64)).cast("int")
    return F.pmod(place, F.lit(SLOTS)), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)


def _sifted(rows: DataFrame, by: tuple[str, str], asked: DataFrame, names: tuple[str, str]) -> DataFrame:
    """``rows`` with ``_maybe``: false only where no row of ``asked`` has the same doc_id, null or not, and key."""
    slot, mark = _slot_and_mark(*names)
    sieve = asked.select(slot.alias("_slot"), mark.alias("_mark")).groupBy("_slot").agg(F.bit_or("_mark").alias("_marks"))
    slot, mark = _slot_and_mark(*by)
    found = rows.withColumn("_at", slot).join(F.broadcast(sieve), F.col("_at") == F.col("_slot"), "left")
    maybe = F.coalesce(F.col("_marks").bitwiseAND(mark) != 0, F.lit(False))
    return found.withColumn("_maybe", maybe).drop("_at", "_slot", "_marks")


def _texts_of(some: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(rep, text) of some nodes: one text of each, however many rows repeat it."""
    rows = nodes.join(some, "rep", "left_semi").select("rep", F.col("row.doc_id").alias("_id"), F.col("row.key").alias("_key"))
    likely = _sifted(_keyed(docs), ("doc_id", "key"), rows, ("_id", "_key")).filter("_maybe").drop("_maybe")
    found = likely.join(rows, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")))
    return found.groupBy("rep").agg(F.first("text").alias("text"))


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    ends = pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))).distinct()
    texts = _texts_of(ends, nodes, docs)
    right = texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b"))
    left = texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_linked, "a binary, b binary")


_SIZES_FIT = "100 * least(n, m) >= 80 * greatest(n, m)"


def _shared(nodes: DataFrame) -> DataFrame:
    """(band, key, size, rep, n) of the members of buckets with two members or more."""
    bands = nodes.select("rep", "n", F.posexplode("sketch").alias("band", "key"))
    sizes = bands.groupBy("band", "key").agg(F.count("*").alias("size")).filter("size > 1")
    return bands.join(sizes, ["band", "key"]).select("band", "key", "size", "rep", "n")


def _star_pairs(shared: DataFrame) -> DataFrame:
    """Every member of a bucket with the bucket's smallest member."""
    heads = shared.groupBy("band", "key").agg(F.min(F.struct("rep", "n")).alias("head"))
    heads = heads.select("band", "key", F.col("head.rep").alias("a"), F.col("head.n").alias("m"))
    pairs = shared.join(heads, ["band", "key"]).filter(f"rep > a and {_SIZES_FIT}")
    return pairs.select("a", F.col("rep").alias("b")).distinct()


class _Block:
    """Members of one block that were seen so far; members and guests are compared with those."""

    def __init__(self) -> None:
        self.rep: list[bytes] = []
        self.sets: list[np.ndarray] = []
        self.size, self.root = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.sketch = np.zeros((0, COORDINATES), np.uint16)
        self.number: dict[bytes, int] = {}
        self.alias: dict[int, int] = {}

    def links(self, rep: bytes, root_name: bytes, sketch: np.ndarray, shown: np.ndarray, member: bool) -> Iterator[tuple[bytes, bytes]]:
        """Links of one row, at most one to each component that is still apart from its own."""
        root = self.number.setdefault(root_name, len(self.number))
        while root in self.alias:
            root = self.alias[root]
        n = len(shown)
        likely = np.flatnonzero(self.root != root)
        likely = likely[100 * np.minimum(self.size[likely], n) >= 80 * np.maximum(self.size[likely], n)]
        likely = likely[(self.sketch[likely] == sketch).sum(axis=1) >= LEAST_AGREEMENT]
        for j in likely:
            if self.root[j] == root:
                continue
            both = np.count_nonzero(_found_in(shown, self.sets[j]))
            if 100 * both >= 80 * (n + self.size[j] - both):
                yield min(rep, self.rep[j]), max(rep, self.rep[j])
                self.alias[int(self.root[j])] = root
                self.root[self.root == self.root[j]] = root
        if member:
            self.rep.append(rep)
            self.sets.append(shown)
            self.size, self.root = np.append(self.size, n), np.append(self.root, root)
            self.sketch = np.concatenate([self.sketch, sketch[None]])


def _links_between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between components, from rows sorted by block, members first."""
    last, block = None, _Block()
    for batch in batches:
        host, part, rep, root = (T.column(batch, c).to_pylist() for c in ("host", "part", "rep", "root"))
        guest = T.column(batch, "guest").to_pylist()
        sketch = T.column(batch, "sketch").flatten().to_numpy().view("<u2").reshape(-1, COORDINATES)
        sets = (shown for _, _, data, offsets in T.slices(T.column(batch, "text")) for shown in shingle_sets(data, offsets))
        links = []
        for i, shown in enumerate(sets):
            if (host[i], part[i]) != last:
                last, block = (host[i], part[i]), _Block()
            links += block.links(rep[i], root[i], sketch[i], shown, not guest[i])
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.binary()) for k in (0, 1)], ["a", "b"])


def _found_in(some: np.ndarray, others: np.ndarray) -> np.ndarray:
    at = np.searchsorted(others, some)
    at[at == len(others)] = 0
    return others[at] == some


def _rest_links(shared: DataFrame, nodes: DataFrame, roots: DataFrame, docs: DataFrame) -> DataFrame:
    """Links between components within the buckets that hold several of them."""
    rooted = nodes.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "rep"))
    # The pair in a bucket of two has been compared already.
    bands = shared.filter("size > 2").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    bands = bands.withColumn("root", F.coalesce("root", "rep"))
    open_buckets = bands.groupBy("band", "key").agg(F.min("root").alias("_least"), F.max("root").alias("_most"))
    open_buckets = open_buckets.filter("_least < _most").select("band", "key")
    inside = scratch.stored(bands.join(open_buckets, ["band", "key"]).select("band", "key", "size", "rep"), "open", shared.count())
    # Everyone's home is the largest of the own buckets, dealt into blocks of bounded size.
    home = inside.groupBy("rep").agg(F.max(F.struct("size", "band", "key")).alias("home"))
    share = F.pmod(F.xxhash64("rep", F.lit(1)), F.ceil(F.col("home.size") / BLOCK))
    home = home.select("rep", F.xxhash64("home.band", "home.key", share).alias("block"))
    homes = scratch.stored(home, "homes", inside.count())
    # Blocks that share a bucket meet: the members of the smaller one are guests of the larger.
    order = homes.groupBy("block").agg(F.count("*").alias("n")).select("block", F.struct("n", "block").alias("order"))
    blocks = inside.join(homes, "rep").select("band", "key", "block").distinct().join(order, "block")
    hosts = blocks.select("band", "key", F.col("block").alias("host"), F.col("order").alias("larger"))
    meets = blocks.join(hosts, ["band", "key"]).filter("order < larger").select("block", "host").distinct()
    guests = homes.join(meets, "block").select("host", "rep", F.lit(True).alias("guest"))
    parts = guests.groupBy("host").agg(F.ceil(F.count("*") / GUESTS).cast("int").alias("parts"))
    guests = guests.join(parts, "host").withColumn("part", F.pmod(F.xxhash64("rep", F.lit(2)), "parts").cast("int"))
    members = homes.withColumnRenamed("block", "host").join(parts, "host", "left")
    each = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part")
    members = members.select("host", "rep", F.lit(False).alias("guest"), each)
    seats = members.unionByName(guests.select("host", "rep", "guest", "part"))
    known = _texts_of(homes, nodes, docs).join(rooted.select("rep", "root", "sketch"), "rep")
    spread = seats.join(known, "rep").select("host", "part", "guest", "rep", "root", "sketch", "text")
    spread = spread.repartition("host", "part").sortWithinPartitions("host", "part", "guest")
    return spread.mapInArrow(_links_between, "a binary, b binary")


def _grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key, n_shingles, digest) of every row, and (digest, n_rows, first, component_id) of every class.

    ``first`` is the doc_id (null last) and text digest of the row that stands for the component.
    """
    known = scratch.stored(_keyed(docs).mapInArrow(_sketched, SKETCHED), "sketches")
    row = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "key")
    nodes = known.filter("n_shingles > 0").groupBy(F.col("digest").alias("rep")).agg(
        F.min(row).alias("row"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"), F.count("*").alias("n_rows")
    )
    nodes = scratch.stored(nodes, "classes", known.count())
    shared = scratch.stored(_shared(nodes), "shared")
    pairs = scratch.stored(_star_pairs(shared), "pairs", shared.count())
    roots = components(_verified(pairs, nodes, docs), pairs.count())
    more = scratch.stored(_rest_links(shared, nodes, roots, docs), "links")
    if found := more.count():
        # A component's star stands for its links.
        stars = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = components(stars.unionByName(more), stars.count() + found)
    rooted = nodes.select("rep", "row", "n_rows").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "rep"))
    firsts = rooted.groupBy("root").agg(F.min("row").alias("first"))
    classes = rooted.join(firsts, "root").select(F.col("rep").alias("digest"), "n_rows", "first", F.col("first.doc_id").alias("component_id"))
    return known.select("doc_id", "key", "n_shingles", "digest"), scratch.stored(classes, "components", nodes.count())


def group_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row; see the module's text."""
    known, classes = _grouped(docs)
    rows = known.filter("n_shingles > 0")
    # Classes of many copies are split over tasks.
    heavy = classes.filter(F.col("n_rows") > fair_share(known.count(), known)).select("digest")
    found = spread_left_join(rows, classes.select("digest", "component_id"), "digest", ["doc_id", "key"], heavy)
    alone = known.filter("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id"]
    return found.select(*columns).unionByName(alone.select(*columns)).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows without those that another row of their component stands for."""
    known, classes = _grouped(docs)
    counts = known.filter("n_shingles > 0").groupBy("doc_id", "key", "digest").agg(F.count("*").alias("n"))
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("key") == F.col("first.key"))
    # Rows that go, and rows of which one copy stays; all others pass untouched.
    decided = counts.join(classes, "digest").select(F.col("doc_id").alias("_of"), F.col("key").alias("_with"), stays.alias("_stays"), "n")
    decided = scratch.stored(decided.filter(~F.col("_stays") | (F.col("n") > 1)), "decided", known.count())
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), docs["doc_id"].cast("bigint").alias("_id"), _text_key().alias("_key"))
    sifted = _sifted(whole, ("_id", "_key"), decided, ("_of", "_with"))
    asked = sifted.filter("_maybe")
    same = F.col("_id").eqNullSafe(F.col("_of")) & (F.col("_key") == F.col("_with"))
    passing = sifted.filter("not _maybe").select("_row")
    passing = passing.unionByName(asked.join(decided.select("_of", "_with"), same, "left_anti").select("_row"))
    repeated = asked.join(decided.filter("_stays").select("_of", "_with"), same, "left_semi")
    one_each = repeated.groupBy("_id", "_key").agg(F.min_by("_row", F.xxhash64("_row")).alias("_row")).select("_row")
    return passing.unionByName(one_each).select("_row.*")
