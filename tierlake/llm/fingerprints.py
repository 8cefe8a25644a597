"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text's paragraphs are the sentences of its lines: pieces end at a line's end and at the blank after a full stop, question mark or
exclamation mark, whatever their length. Each distinct paragraph's 64-bit digest is thrown into one cell of each of three tables; a cell holds how many
digests it has, their exclusive or, and the exclusive or of their checks. The sketch of 24 cells, written
out, is the fingerprint. Subtracting the sketches of two versions cell by cell cancels all that they share;
peeling then takes out digests from cells that hold a single one, until every differing digest is
recovered. Where a peel fails the difference was too large, and both sketches are made again larger: the
digests are dealt by hash over so many sketches of 24 cells that each expects a few differences. A sketch
that still gets stuck (two digests with the same three slots never peel, 1 in 512 pairs) has only its own
digests dealt again, over twice, four and eight times as many sketches with other hashes; what is stuck
after that is compared digest by digest, so that the count is exact for texts of any length. Likeness is
common over all distinct digests.

The next document is the one with the next smaller doc_id; the last is followed by the first. Rows are placed
by bounds from a quantile summary, as many as shuffle partitions times four, that need not be doc_ids
themselves (they are not beyond 2^53). A row finds its bucket among every n-th of n^2 bounds and then among n of them, and all else
about a bucket by its number. The greatest doc_id of each bucket comes from the data, and its rows are
copied to the end of the bucket after which it follows: one shuffle of the texts, no bucket that grows with
the table unless one doc_id does, nothing collected but the bounds and these doc_ids.

Null texts count as empty: no cells, likeness 1 to another empty text and 0 to others. Rows that repeat a
doc_id follow each other in the order of their texts; null doc_ids come last, in the order of a hash of their
texts, by ranges of which they are placed, before the first row follows again. One document alone is followed
by itself. An empty table gives no rows.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierlake.llm import text as T

TABLES, SLOTS = 3, 8
CELLS = TABLES * SLOTS
PIECE_ENDS = r"\n|(?<=[.!?])\x20"
ROUNDS = 10
# Differing digests that each sketch of 24 cells should meet when a sketch is made larger.
LOAD = 7
RETRIES = (1, 2, 4, 8)
BUCKETS_PER_PARTITION = 4


def digests(text: Column) -> Column:
    """Distinct digests of the paragraphs that are not empty."""
    pieces = F.filter(F.split(text, PIECE_ENDS), lambda p: p != "")
    return F.array_distinct(F.transform(pieces, lambda p: F.xxhash64(p)))


def _check(key: Column) -> Column:
    return F.hash(key, F.lit(77))


def _slots(key: Column, seed: int | Column) -> list[Column]:
    return [F.pmod(F.hash(key, F.lit(seed * TABLES + t)), SLOTS) + t * SLOTS for t in range(TABLES)]


def _cell(n: Column, k: Column, c: Column) -> Column:
    return F.struct(n.cast("int").alias("n"), k.cast("bigint").alias("k"), c.cast("int").alias("c"))


def sketch(keys: Column, seed: int | Column) -> Column:
    """Cells of a set of digests."""
    thrown = F.transform(keys, lambda k: F.struct(k.alias("k"), _check(k).alias("c"), *[s.alias(f"s{t}") for t, s in enumerate(_slots(k, seed))]))

    def filled(entries: Column) -> Column:
        def cell(table: int, slot: Column) -> Column:
            own = F.filter(entries, lambda e: e[f"s{table}"] == slot)
            return F.aggregate(
                own,
                _cell(F.lit(0), F.lit(0), F.lit(0)),
                lambda a, e: _cell(a["n"] + 1, a["k"].bitwiseXOR(e["k"]), a["c"].bitwiseXOR(e["c"])),
            )

        def table(t: int) -> Column:
            return F.transform(F.sequence(F.lit(t * SLOTS), F.lit(t * SLOTS + SLOTS - 1)), lambda slot: cell(t, slot))

        return F.concat(*map(table, range(TABLES)))

    return T.let(thrown, filled)


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: _cell(x["n"] - y["n"], x["k"].bitwiseXOR(y["k"]), x["c"].bitwiseXOR(y["c"])))


def peel(cells: Column, seed: int | Column) -> Column:
    """How many digests a difference of sketches holds; null where peeling gets stuck."""

    def step(state: Column, _: Column) -> Column:
        single = F.filter(state["cells"], lambda x: (F.abs(x["n"]) == 1) & (_check(x["k"]) == x["c"]))
        pure = F.array_distinct(F.transform(single, lambda x: F.struct(x["k"].alias("k"), x["n"].alias("n"), x["c"].alias("c"))))
        placed = F.transform(pure, lambda p: F.struct(p.alias("p"), F.array(*_slots(p["k"], seed)).alias("s")))

        def without(gone: Column) -> Column:
            def cleared(x: Column, i: Column) -> Column:
                here = F.filter(gone, lambda g: F.array_contains(g["s"], i))
                return F.aggregate(
                    here,
                    x,
                    lambda a, g: _cell(a["n"] - g["p"]["n"], a["k"].bitwiseXOR(g["p"]["k"]), a["c"].bitwiseXOR(g["p"]["c"])),
                )

            after = F.transform(state["cells"], cleared)
            left = F.exists(after, lambda x: x["n"] != 0)
            more = F.struct(after.alias("cells"), (state["found"] + F.size(gone)).alias("found"), left.alias("go_on"))
            return F.when(F.size(gone) == 0, state.withField("go_on", F.lit(False))).otherwise(more)

        return F.when(state["go_on"], T.let(placed, without)).otherwise(state)

    start = F.struct(cells.alias("cells"), F.lit(0).alias("found"), F.lit(True).alias("go_on"))
    end = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)
    return T.let(end, lambda s: F.when(F.forall(s["cells"], lambda x: (x["n"] == 0) & (x["k"] == 0)), s["found"]))


def _larger(state: Column, times: Column) -> Column:
    """Differing digests of what is left of two sets, by many sketches of 24 cells; what got stuck is left."""
    groups = F.ceil((F.size(state["a"]) + F.size(state["b"])) * times / LOAD).cast("int")

    # Groups are picked out in two steps, so that a text of many paragraphs is not read once for each group.
    width = F.ceil(F.sqrt(groups.cast("double"))).cast("int")

    def counted(pair: Column) -> Column:
        def some(s: Column) -> Column:
            def part(keys: Column) -> Column:
                return F.filter(keys, lambda x: F.floor(x["g"] / pair["w"]) == s)

            def within(near: Column) -> Column:
                def own(keys: Column, g: Column) -> Column:
                    return F.transform(F.filter(keys, lambda x: x["g"] == g), lambda x: x["k"])

                def one(g: Column) -> Column:
                    return T.let(F.struct(own(near["a"], g).alias("a"), own(near["b"], g).alias("b")), peeled)

                last = F.least((s + 1) * pair["w"], pair["n"]) - 1
                return F.when(s * pair["w"] <= last, F.transform(F.sequence(s * pair["w"], last), one))

            return T.let(F.struct(part(pair["a"]).alias("a"), part(pair["b"]).alias("b")), within)

        each = F.transform(F.sequence(F.lit(0), F.ceil(pair["n"] / pair["w"]).cast("int") - 1), some)
        return T.let(F.flatten(F.filter(each, lambda x: x.isNotNull())), gathered)

    def peeled(keys: Column) -> Column:
        found = peel(subtract(sketch(keys["a"], times), sketch(keys["b"], times)), times)
        return F.struct(found.alias("found"), keys["a"].alias("a"), keys["b"].alias("b"))

    def gathered(each: Column) -> Column:
        stuck = F.filter(each, lambda x: x["found"].isNull())
        found = F.aggregate(each, state["found"], lambda total, x: total + F.coalesce(x["found"], F.lit(0)))
        return _state(found, F.flatten(F.transform(stuck, lambda x: x["a"])), F.flatten(F.transform(stuck, lambda x: x["b"])))

    def dealt(keys: Column) -> Column:
        return F.transform(keys, lambda k: F.struct(k.alias("k"), F.pmod(F.xxhash64(k, times), groups).cast("int").alias("g")))

    larger = T.let(F.struct(dealt(state["a"]).alias("a"), dealt(state["b"]).alias("b"), groups.alias("n"), width.alias("w")), counted)
    return F.when(groups == 0, state).otherwise(larger)


def _state(found: Column, a: Column, b: Column) -> Column:
    return F.struct(found.cast("int").alias("found"), a.alias("a"), b.alias("b"))


def _retried(a: Column, b: Column) -> Column:
    """Differing digests of two sets by larger sketches, and by the digests themselves where those get stuck."""
    end = F.aggregate(F.array(*map(F.lit, RETRIES)), _state(F.lit(0), a, b), _larger)

    def rest(s: Column) -> Column:
        return s["found"] + F.size(s["a"]) + F.size(s["b"]) - 2 * F.size(F.array_intersect(s["a"], s["b"]))

    return T.let(end, rest)


def likeness(a: Column, b: Column, cells_a: Column, cells_b: Column) -> Column:
    """Share of common digests by subtracting sketches, larger ones where the fingerprints' own fail."""
    differing = F.coalesce(peel(subtract(cells_a, cells_b), 0), _retried(a, b))
    total = F.size(a) + F.size(b)

    def share(d: Column) -> Column:
        return F.when(total == 0, 1.0).otherwise((total - d) / (total + d))

    return T.let(differing, share)


def written(cells: Column) -> Column:
    """A sketch as text: count, digests and checks of each cell in hexadecimals, nothing for an empty cell."""

    def one(x: Column) -> Column:
        return F.when(x["n"] == 0, "").otherwise(F.concat_ws(".", F.hex(x["n"]), F.hex(x["k"]), F.right(F.hex(x["c"]), F.lit(8))))

    return F.array_join(F.transform(cells, one), ",")


def _nameless() -> Column:
    """Orders rows without doc_id."""
    return F.xxhash64("text")


def _fixed(values: list[int | None]) -> Column:
    """An array of numbers, folded into one literal."""
    return F.from_json(F.lit(json.dumps(values)), "array<bigint>")


def _bucket(bounds: list[int], parts: int) -> Column:
    """How many bounds are below a doc_id; null doc_ids in ``parts`` ranges of their hash, below 0."""
    width = math.isqrt(len(bounds)) + 1
    edges = _fixed(bounds)

    def below(some: Column) -> Column:
        return F.size(F.filter(some, lambda bound: bound < F.col("doc_id")))

    own = T.let(below(_fixed(bounds[width - 1 :: width])), lambda k: k * width + below(F.slice(edges, k * width + 1, width)))
    part = F.floor((_nameless() / 2.0**64 + 0.5) * parts).cast("int")
    return F.when(F.col("doc_id").isNull(), -1 - F.least(part, F.lit(parts - 1))).otherwise(own).cast("int")


def _placed(rows: DataFrame) -> DataFrame:
    """Rows of (doc_id, text) with their ``place``: in their bucket, and once more for heads, after the bucket before.

    Buckets follow each other by falling numbers; those of null doc_ids are below 0.
    """
    buckets = BUCKETS_PER_PARTITION * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = F.expr(f"array({', '.join(f'{(k + 1) / buckets!r}D' for k in range(buckets))})")
    ids = rows.agg(
        F.percentile_approx("doc_id", shares, 20 * buckets).alias("bounds"),
        F.count("*").alias("n"), F.count_if(F.col("doc_id").isNull()).alias("nameless"),
    ).first()
    bounds = sorted(set(ids["bounds"] or []))
    parts = max(1, -(-buckets * ids["nameless"] // max(1, ids["n"])))
    rows = rows.withColumn("bucket", _bucket(bounds, parts))
    # Buckets of doc_ids have a greatest doc_id, those of null doc_ids a smallest hash.
    firsts = rows.groupBy("bucket").agg(F.max("doc_id").alias("doc_id"), F.min(_nameless()).alias("hash"))
    heads = {h["bucket"]: h for h in firsts.orderBy(F.desc("bucket")).collect()}
    before = dict(zip(heads, [*list(heads)[-1:], *heads]))

    def known(found: dict) -> Column:
        numbers = [found.get(b) for b in range(-parts, len(bounds) + 1)]
        return F.element_at(_fixed(numbers), F.col("bucket") + parts + 1)

    first_id = F.col("doc_id") == known({b: h["doc_id"] for b, h in heads.items()})
    first_hash = _nameless() == known({b: h["hash"] for b, h in heads.items()})
    is_head = F.when(F.col("doc_id").isNull(), first_hash).otherwise(first_id)
    here = F.struct(F.col("bucket").alias("b"), F.lit(0).alias("t"))
    after = F.struct(known(before).cast("int").alias("b"), F.lit(1).alias("t"))
    return rows.withColumn("place", F.explode(F.when(is_head, F.array(here, after)).otherwise(F.array(here)))).drop("bucket")


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, digests, next_text, next_digests) of every document."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), T.text_or_empty().alias("text"))
    rows = _placed(rows).withColumn("digests", digests(F.col("text")))
    nameless = F.when(F.col("doc_id").isNull(), _nameless())
    order = Window.partitionBy("place.b").orderBy(F.col("place.t"), F.col("doc_id").desc_nulls_last(), nameless, "text")
    rows = rows.withColumns({"next_text": F.lead("text").over(order), "next_digests": F.lead("digests").over(order)})
    rows = rows.filter("place.t = 0")
    empty = F.array().cast("array<bigint>")
    return rows.select(
        "doc_id", "text", "digests", F.coalesce("next_text", F.lit("")).alias("next_text"),
        F.coalesce("next_digests", empty).alias("next_digests"),
    )


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every document."""
    rows = with_next(docs).withColumn("n_chars", F.char_length("text").cast("int"))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars") - cut), F.substring("next_text", F.lit(1), cut))
    rows = rows.withColumn("edited", edited).withColumn("edited_digests", digests(F.col("edited")))
    rows = rows.select(
        "doc_id", F.col("n_chars").cast("bigint").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "digests", "edited_digests", "next_digests",
        *[sketch(F.col(c), 0).alias(f"{c}_cells") for c in ("digests", "edited_digests", "next_digests")],
    )
    own = (F.col("digests"), F.col("digests_cells"))

    def near(other: str) -> Column:
        return likeness(own[0], F.col(other), own[1], F.col(f"{other}_cells"))

    return rows.select(
        "doc_id", "n_chars", "edited_sha256", written(own[1]).alias("fingerprint"),
        written(F.col("edited_digests_cells")).alias("edited_fingerprint"),
        near("edited_digests").alias("near_edited"), near("next_digests").alias("near_next"),
    )
