"""How filters interact: failing-id relations and every order of applying them.

Each filter has one stored id table, the rows it fails. What a filter removes
after a set of others is its table left-anti joined with theirs, one after the
other; what was gone before it is the left-semi part of the same joins. Sets,
not orders, are walked (each once, its letters ascending), so five filters need
80 relations for their 600 steps, and only failing rows ever move: 16 bytes of
key and a few counts each.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from buyerlens.llm.base import prepare
from buyerlens.session import materialize

UPPER = bytes(range(65, 91))
MARKS = b"#$%&*|"
FACTS = "key binary, id long, part string, digest binary, n_words long, n_distinct long, n_upper long, n_points long, marked boolean"
# What fails a filter, over the facts of a row; a copy is told by a relation instead.
CONDITIONS = {
    "A": "n_words < 200",
    "B": "100 * n_distinct < 50 * n_words",
    "C": "100 * n_upper > 3 * n_points",
    "D": "marked",
}
COPY = "E"


def facts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One pass over the texts: per row its part, what the conditions read, and 128-bit digests of the text and of the whole row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, part, t in zip(*(c.to_pylist() for c in b.columns)):
                raw, part = (t or "").encode(), part or ""
                words = raw.split()  # ASCII white space alone parts words
                digest = hashlib.blake2b(raw, digest_size=16).digest()
                key = hashlib.blake2b(digest + repr(i).encode() + b"\n" + part.encode(), digest_size=16).digest()
                bare = raw.translate(None, UPPER)
                rows.append((key, i, part, digest, len(words), len(set(words)), len(raw) - len(bare),
                             len(t or ""), len(raw.translate(None, MARKS)) < len(raw)))
            cols = list(zip(*rows)) if rows else [()] * 9
            types = (pa.binary(), pa.int64(), pa.string(), pa.binary(), *[pa.int64()] * 4, pa.bool_())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types)],
                                  ["key", "id", "part", "digest", "n_words", "n_distinct", "n_upper", "n_points", "marked"])

    prepare(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(part_col).cast("string").alias("part"),
                      F.col(text_col).alias("text"))
    return src.mapInArrow(run, FACTS)


def units(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Equal rows as one with their number ``n``, and how many of them are marked ``good`` and ``toxic``.

    A mark holds for an id if any of its label rows has it.
    """
    names = [c for c in rows.columns if c != "key"]
    one = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), *[F.any_value(c).alias(c) for c in names])
    marks = (labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id"))
             .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("g"),
                  F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("t")))
    return (one.join(marks, "id", "left")
            .withColumn("good", F.when(F.col("g"), F.col("n")).otherwise(0))
            .withColumn("toxic", F.when(F.col("t"), F.col("n")).otherwise(0)).drop("g", "t"))


def copies(rows: DataFrame) -> DataFrame:
    """Rows whose text a smaller id has too. The first id of a text combines map-side; the anti join
    is by text and id, so a text that a third of all rows hold is no hot key."""
    known = rows.where(F.col("id").isNotNull())
    firsts = known.groupBy("digest").agg(F.min("id").alias("id"))
    return known.join(firsts, ["digest", "id"], "left_anti")


def failing_ids(rows: DataFrame) -> DataFrame:
    """The id tables of all filters, stored as one table by ``filter``: ``(filter, key, part, n, good, toxic)``."""
    keep = ["key", "part", "n", "good", "toxic"]
    own = F.filter(F.array(*[F.when(F.expr(c), F.lit(f)) for f, c in CONDITIONS.items()]), lambda f: f.isNotNull())
    by_condition = rows.select(F.explode(own).alias("filter"), *keep)
    return materialize(by_condition.unionByName(copies(rows).select(F.lit(COPY).alias("filter"), *keep)))


def relations(failing: DataFrame, letters: str) -> DataFrame:
    """Per part, filter and set of earlier filters (``before``, ascending): ``removed`` with its
    marked rows, and ``redundant`` (by that set's last filter alone; its shorter sets hold the rest).

    Round k holds the rows of each filter that no filter of a set of k fails.
    A round joins them with the id tables of each further letter: the left-anti
    part is the next round, the left-semi part was removed earlier.
    """
    def sums(df: DataFrame, removed: bool) -> DataFrame:
        at = {c: F.sum(c) if removed else F.lit(0).cast("long") for c in ("n", "good", "toxic")}
        return df.groupBy("part", "filter", "before").agg(
            at["n"].alias("removed"), at["good"].alias("good_lost"), at["toxic"].alias("toxic_lost"),
            (F.lit(0).cast("long") if removed else F.sum("n")).alias("redundant"))

    alive = failing.withColumn("before", F.lit(""))
    out = sums(alive, True)
    tables = failing.select(F.col("filter").alias("next"), "key")
    for _ in range(len(letters) - 1):
        later = F.filter(F.split(F.lit(letters), ""), lambda x: (x > F.substring("before", -1, 1)) & (x != F.col("filter")))
        asked = alive.withColumn("next", F.explode(later))
        grown = F.concat("before", "next").alias("before")
        kept = ["filter", "key", "part", "n", "good", "toxic", grown]
        out = out.unionByName(sums(asked.join(tables, ["next", "key"], "left_semi").select(*kept), False))
        alive = materialize(asked.join(tables, ["next", "key"], "left_anti").select(*kept))
        out = out.unionByName(sums(alive, True))
    return out.groupBy("part", "filter", "before").agg(*[F.sum(c).alias(c) for c in ("removed", "good_lost", "toxic_lost", "redundant")])


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step: ``(part, filter_order, step, kept, removed,
    redundant, unique_fails, good_lost, toxic_lost, shapley)``.

    Null texts are empty, a null part is the empty one. A row without an id
    copies nothing and is no first; repeated rows count each and are no copies
    of one another. Rows of one id with different texts count each, with the
    id's marks. Other columns are not read. An empty table has no parts: no rows.
    """
    letters = "".join([*CONDITIONS, COPY])
    rows = materialize(units(facts(docs, id_col, text_col, part_col), labels, id_col))
    figures = relations(failing_ids(rows), letters)
    # Set by set: what is redundant after a set is what its ascending prefixes took, one after the other.
    prefixes = [{"filter": f, "before": s, "prefix": s[:k], "whole": k == len(s)}
                for s in subsets(letters) for k in range(len(s) + 1) for f in letters if f not in s]
    parts = rows.groupBy("part").agg(F.sum("n").alias("total"))
    asked = parts.select("part", _rows(prefixes, "filter string, before string, prefix string, whole boolean"))
    found = figures.withColumnRenamed("before", "prefix")
    per_set = (asked.join(found, ["part", "filter", "prefix"], "left").groupBy("part", "filter", "before")
               .agg(*[F.sum(F.when(F.col("whole"), F.col(c))).alias(c) for c in ("removed", "good_lost", "toxic_lost")],
                    F.sum("redundant").alias("redundant"))
               .na.fill(0, ["removed", "redundant", "good_lost", "toxic_lost"]))
    steps = [{"filter_order": "".join(o), "step": k + 1, "filter": o[k], "before": "".join(sorted(o[:k]))}
             for o in permutations(letters) for k in range(len(letters))]
    plan = parts.select("part", "total", _rows(steps, "filter_order string, step int, filter string, before string"))
    full = plan.join(per_set, ["part", "filter", "before"])
    along = Window.partitionBy("part", "filter_order").orderBy("step")
    of_filter = Window.partitionBy("part", "filter")
    last = F.length("before") == len(letters) - 1
    return full.select(
        "part", "filter_order", "step", (F.col("total") - F.sum("removed").over(along)).alias("kept"), "removed", "redundant",
        F.max(F.when(last, F.col("removed"))).over(of_filter).alias("unique_fails"),
        "good_lost", "toxic_lost", F.sum("removed").over(of_filter).alias("shapley"))


def _rows(values: list[dict], schema: str) -> Column:
    """A fixed small table beside each row."""
    return F.inline(F.from_json(F.lit(json.dumps(values)), f"array<struct<{schema.replace(' ', ':')}>>".replace(",:", ",")))


def subsets(letters: str) -> list[str]:
    out = [""]
    for x in letters:
        out += [s + x for s in out]
    return out


ORACLE = r"""
with rows_ as (
  select coalesce(d.lang, '') as part, d.doc_id, coalesce(d.text, '') as text,
         list_filter(string_split_regex(coalesce(d.text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words,
         coalesce(m.good, false) as good, coalesce(m.toxic, false) as toxic
  from documents d left join (
    select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id) m using (doc_id)),
failed as (
  select part, good, toxic,
         concat(case when len(words) < 200 then 'A' else '' end,
                case when 100 * len(list_distinct(words)) < 50 * len(words) then 'B' else '' end,
                case when 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) then 'C' else '' end,
                case when regexp_matches(text, '[#$%&*|]') then 'D' else '' end,
                case when doc_id > min(doc_id) over (partition by text) then 'E' else '' end) as fails
  from rows_),
profiles as (select part, fails, good, toxic, count(*) as n from failed group by all),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as f),
orders as (
  select a.f || b.f || c.f || d.f || e.f as filter_order from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps as (
  select filter_order, s::int as step, substr(filter_order, s, 1) as f, substr(filter_order, 1, s - 1) as before
  from orders, range(1, 6) t(s)),
counted as (
  select part, filter_order, step, f,
         sum(case when translate(fails, before || f, '') = fails then n else 0 end) as kept,
         sum(case when contains(fails, f) and translate(fails, before, '') = fails then n else 0 end) as removed,
         sum(case when contains(fails, f) and translate(fails, before, '') <> fails then n else 0 end) as redundant,
         sum(case when fails = f then n else 0 end) as unique_fails,
         sum(case when good and contains(fails, f) and translate(fails, before, '') = fails then n else 0 end) as good_lost,
         sum(case when toxic and contains(fails, f) and translate(fails, before, '') = fails then n else 0 end) as toxic_lost
  from profiles, steps group by all)
select part, filter_order, step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
       unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
       (sum(removed) over (partition by part, f))::bigint as shapley
from counted
"""
