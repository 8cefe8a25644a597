"""Licence scan by a positional index of rare words.

Templates are licence phrases with a label. Document frequencies of all their words are counted over the
whole table; each phrase is indexed under its two words of highest IDF, with their offsets. A file that has
one of the rarest words is looked up: each occurrence votes for the place where the phrase would start,
and the votes of the two words are intersected, so only phrases whose rare words stand at the right
distance remain. At such a place the mandatory key phrase, all its words in order, is verified. As every
place of a phrase has both words, none is missed whatever the frequencies are.

Words are runs of ASCII letters and digits, A-Z lower-cased, and of any code points beyond ASCII. A null text
counts as empty. Texts without a phrase have no labels, null positions and score 0. Rows are independent, so
repeated rows give equal results; an empty table gives no rows; a phrase may overlap another. The
frequencies that reach the driver are as many as the templates have words.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tierlake.llm import text as T

# What stands between words, before and after lower-casing. Splitting at it is much faster than matching words.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """Words that must stand consecutively; base templates also count towards the base columns."""

    label: str
    phrase: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.phrase.split()


# Phrases and labels.
TEMPLATES = (
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    Template("apache-2", "www apache org licenses license 2 0"),
    Template("gpl", "gnu general public license"),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license"),
    Template("mpl-2", "mozilla public license version 2"),
    Template("mpl-2", "mozilla public license v 2"),
    Template("bsd", "redistribution and use in source and binary forms"),
    Template("bsd", "under the bsd license"),
    Template("isc", "permission to use copy modify and or distribute this software"),
    Template("cc-by", "creative commons attribution"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc0", "cc0 1 0 universal"),
    Template("unlicense", "this is free and unencumbered software"),
    Template("all-rights-reserved", "all rights reserved"),
)


def pieces() -> Column:
    """Words in small letters, perhaps with an empty string at either end.

    Beyond ASCII the case is of no account, as no phrase has such letters.
    """
    text = T.text_or_empty()
    # Only these two letters become ASCII ones when small.
    odd = F.contains(text, F.lit("\u0130")) | F.contains(text, F.lit("\u212a"))
    return F.split(F.when(odd, T.ascii_lower(text)).otherwise(F.lower(text)), GAP)


def words() -> Column:
    return F.array_remove(pieces(), "")


def n_words() -> Column:
    def inner(p: Column) -> Column:
        ends = (F.get(p, F.lit(0)) == "").cast("int") + ((F.size(p) > 1) & (F.element_at(p, -1) == "")).cast("int")
        return F.size(p) - ends

    return T.let(F.split(T.text_or_empty(), GAP_ANY_CASE), inner)


def frequencies(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> tuple[int, dict[str, int]]:
    """Documents, and documents with each template word: at most one row per such word comes back."""
    vocabulary = F.array(*map(F.lit, sorted({w for t in templates for w in t.words})))
    # The empty string is in no text as a word; it counts the documents.
    found = docs.select(F.explode(F.concat(F.array(F.lit("")), F.array_intersect(pieces(), vocabulary))).alias("w"))
    counted = {r.w: r.n for r in found.groupBy("w").agg(F.count("*").alias("n")).collect()}
    return counted.pop("", 0), counted


def weights(total: int, counted: dict[str, int], templates: tuple[Template, ...]) -> list[float]:
    """IDF mass of each template relative to the largest."""
    idf = [[math.log((total + 1) / (counted.get(w, 0) + 1)) for w in t.words] for t in templates]
    mass = [sum(x) for x in idf]
    return [m / max(mass) if max(mass) > 0 else 0.0 for m in mass]


def _postings(counted: dict[str, int], templates: tuple[Template, ...]) -> tuple[list[str], list[dict[str, list[tuple[int, int]]]]]:
    """The rarest word of each phrase, and for the rarest and the next one: word to (template, offset)."""
    rarest, by_rank = [], [{}, {}]
    for number, template in enumerate(templates):
        order = sorted(range(len(template.words)), key=lambda k: (counted.get(template.words[k], 0), k))
        rarest.append(template.words[order[0]])
        for rank in (0, 1):
            offset = order[min(rank, len(order) - 1)]
            by_rank[rank].setdefault(template.words[offset], []).append((number, offset))
    return rarest, by_rank


def _struct(number: Column, start: Column) -> Column:
    return F.struct(number.cast("int").alias("t"), start.cast("int").alias("start"))


def _places(found: Column, postings: dict[str, list[tuple[int, int]]]) -> Column:
    """Places where a phrase would start according to the occurrences of the posted words."""
    keys = F.array(*map(F.lit, postings))
    values = [F.array(*[F.struct(F.lit(t).alias("t"), F.lit(o).alias("o")) for t, o in p]) for p in postings.values()]
    index = F.map_from_arrays(keys, F.array(*values)) if len({len(p) for p in postings.values()}) == 1 else F.create_map(
        *[x for key, value in zip(map(F.lit, postings), values, strict=True) for x in (key, value)]
    )
    placed = F.transform(found, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    hits = F.filter(placed, lambda x: F.array_contains(keys, x["w"]))
    return F.flatten(
        F.transform(hits, lambda x: F.transform(F.element_at(index, x["w"]), lambda p: _struct(p["t"], x["i"] - p["o"])))
    )


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every document."""
    total, counted = frequencies(docs, templates)
    rarest, (first, second) = _postings(counted, templates)
    mass = F.array(*[F.lit(w) for w in weights(total, counted, templates)])
    phrases = F.array(*[F.lit(t.phrase) for t in templates])
    lengths = F.array(*[F.lit(len(t.words)) for t in templates])
    labels = F.array(*[F.lit(t.label) for t in templates])
    base = F.array(*[F.lit(t.base) for t in templates])
    likely = T.text_or_empty().rlike(r"(?i)(?<![0-9a-z])(?:" + "|".join(sorted(set(rarest))) + ")(?![0-9a-z])")

    def verified(w: Column) -> Column:
        agreed = F.array_intersect(_places(w, first), _places(w, second))
        return F.filter(
            agreed,
            lambda c: (c["start"] >= 0)
            & (F.array_join(F.slice(w, c["start"] + 1, F.get(lengths, c["t"])), " ") == F.get(phrases, c["t"])),
        )

    nothing = F.filter(F.array(_struct(F.lit(0), F.lit(0))), lambda x: F.lit(False))
    rows = docs.select(
        "doc_id",
        n_words().alias("n"),
        F.when(likely, T.let(words(), verified)).otherwise(nothing).alias("hits"),
    )
    rows = rows.withColumn("based", F.filter("hits", lambda c: F.get(base, c["t"])))

    def named(hits: str) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda c: F.get(labels, c["t"])))), ",")

    starts = F.transform("based", lambda c: c["start"].cast("bigint"))
    score = F.coalesce(F.array_max(F.transform("hits", lambda c: F.get(mass, c["t"]))), F.lit(0.0))
    return rows.select(
        "doc_id",
        F.col("n").cast("bigint").alias("n_words"),
        F.size("based").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        named("based").alias("base_labels"),
        named("hits").alias("labels"),
        F.round(score, 6).alias("score"),
    )


def _report_sql() -> str:
    rows = ", ".join(f"({k}, '{t.label}', '{t.phrase}', {str(t.base).lower()})" for k, t in enumerate(TEMPLATES))
    return rf"""
with templates as (
  select *, string_split(phrase, ' ') as pw from (values {rows}) v(t, label, phrase, base)
), texts as (
  select row_number() over () as r, doc_id,
      regexp_extract_all(translate(coalesce(text, ''), '{T.UPPER}', '{T.LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), vocabulary as (
  select distinct unnest(pw) as word from templates
), counted as (
  select word, count(r) as n from vocabulary left join texts on list_contains(w, word) group by word
), idf as (
  select word, ln(((select count(*) from texts) + 1)::double / (n + 1)) as idf from counted
), mass as (
  select t, sum(idf) as mass from (select t, unnest(pw) as word from templates) join idf using (word) group by t
), weight as (
  select t, case when max(mass) over () > 0 then mass / max(mass) over () else 0 end as weight from mass
), hits as (
  select r, t, label, base, weight, unnest([i - 1 for i in generate_series(1, len(w)) if w[i:i + len(pw) - 1] = pw]) as start
  from texts join (templates join weight using (t)) on list_has_all(w, pw)
), summed as (
  select r, count(*) filter (where base) as n_base, min(start) filter (where base) as first_word,
      max(start) filter (where base) as last_word,
      string_agg(distinct label, ',' order by label) filter (where base) as base_labels,
      string_agg(distinct label, ',' order by label) as labels, max(weight) as score
  from hits group by r
)
select doc_id, len(w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word,
    last_word::bigint as last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
    round(coalesce(score, 0), 6)::double as score
from texts left join summed using (r)
"""


REPORT_SQL = _report_sql()
