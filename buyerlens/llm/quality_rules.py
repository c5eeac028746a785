"""Quality rules whose cutoffs are certified on labelled holdouts.

Each rule compares one shape of a text with a cutoff from a fixed grid that
runs from lenient to strict. Per stratum (language), the labelled good rows
that pass the base conditions are the holdout: a cutoff is certified if, were
the rule's true rate of false rejections above its share of
``max_false_rejection``, a count as low as the one seen would come with a
probability of at most ``delta`` over the number of tests (the exact binomial
tail, which is the Clopper-Pearson bound read backwards). Along a grid the
cutoffs are tested in order up to the first failure, which costs no
correction; rules and strata are corrected for by Bonferroni, and the rules
share the rate, so all rules together falsely reject at most that rate of a
stratum's good rows, in every stratum at once, with probability 1 - delta.
Of the certified cutoffs the one that rejects most rows marked poor is used.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buyerlens.llm.base import prepare
from buyerlens.operators.joins import fits_broadcast, salted_left_join
from buyerlens.session import materialize

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
SIGNALS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
BASE_FAILED = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"


@dataclass(frozen=True)
class Rule:
    """Rejects a row whose ``value`` (a whole number, SQL over the signals) is above the cutoff, or below it if not ``above``."""
    name: str
    value: str
    above: bool
    grid: tuple[int, ...]  # lenient to strict

    def rejects(self, cutoff: Column) -> Column:
        v = F.expr(self.value)
        return F.coalesce(v > cutoff if self.above else v < cutoff, F.lit(False))

    def place(self) -> Column:
        """Place of the first cutoff that rejects the row; the grid's length if none does."""
        return F.size(F.filter(F.array(*[F.lit(c) for c in self.grid]), lambda c: ~self.rejects(c)))


def per_mille(part: str, whole: str) -> str:
    return f"(1000 * {part}) div greatest({whole}, 1)"


RULES = (
    Rule("symbols", per_mille("n_symbols", "n_words"), True, (1000, 700, 500, 400, 300, 250, 200, 150, 100, 75, 50, 30, 20, 10)),
    Rule("repeats", per_mille("n_repeat_words", "n_words"), True, (450, 400, 350, 300, 250, 200, 150, 100, 75, 50)),
    Rule("dup_lines", per_mille("n_dup_lines", "n_lines"), True, (800, 600, 500, 400, 300, 250, 200, 150, 100, 75, 50)),
    Rule("long_words", per_mille("word_chars", "n_words"), True, (20000, 15000, 12000, 10000, 9000, 8000, 7500, 7000)),
    Rule("short_words", per_mille("word_chars", "n_words"), False, (1500, 2000, 2500, 3000, 3500, 4000)),
)


@dataclass(frozen=True)
class RiskParams:
    max_false_rejection: float = 0.02  # of a stratum's good rows, by all rules together
    delta: float = 0.05  # probability that any stratum's rate is above that
    rules: tuple[Rule, ...] = RULES
    broadcast_rows: int = 100_000  # strata up to which their cutoffs are broadcast
    salts: int = 64  # of a stratum's rows beyond that


def signals_of(text: str) -> tuple[int, ...]:
    """:data:`SIGNALS` of a whole text."""
    raw = text.encode()
    words = raw.split()  # ASCII white space alone parts words
    chars = len(text) - sum(map(text.count, SPACE))
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return (len(words), chars, sum(map(text.count, SYMBOLS)), len(lines), len(lines) - len(set(lines)), repeated_words(words))


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a window of three that the text has more than once."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    w = np.fromiter((number.setdefault(x, len(number)) for x in words), np.int64, len(words))
    pairs = np.unique(w[:-1] * len(number) + w[1:], return_inverse=True)[1]
    _, which, times = np.unique(pairs[:-1] * len(number) + w[2:], return_inverse=True, return_counts=True)
    twice = times[which] > 1
    inside = np.zeros(len(w), bool)
    for k in range(3):
        inside[k:k + len(twice)] |= twice
    return int(inside.sum())


def signals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """``(id_col, stratum, *SIGNALS)`` per row, one pass over the texts; a null text is empty, a null stratum the empty one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = list(zip(*[signals_of(t or "") for t in b.column(2).to_pylist()])) or [()] * len(SIGNALS)
            yield pa.record_batch([b.column(0), b.column(1), *[pa.array(c, pa.int64()) for c in cols]], ["id", "stratum", *SIGNALS])

    prepare(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"),
                      F.col(text_col).alias("text"))
    return src.mapInArrow(run, f"id long, stratum string, {', '.join(f'{s} long' for s in SIGNALS)}").withColumnRenamed("id", id_col)


def tail(k: int, n: int, rate: float) -> float:
    """P(at most ``k`` of ``n``) at ``rate``: the exact binomial distribution."""
    if n == 0 or rate <= 0:
        return 1.0
    at = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(rate) + (n - i) * math.log1p(-rate)
          for i in range(k + 1)]
    return min(1.0, math.fsum(map(math.exp, at)))


def choose(counts: np.ndarray, n_good: int, rate: float, level: float) -> int | None:
    """Index of the cutoff to use, or None. ``counts[i]`` = (good, poor) rows that cutoff ``i`` rejects.

    Cutoffs are tested in order up to the first that is not certified; the
    first of those that reject most poor rows is used, none if that is no row.
    """
    best, most = None, 0
    for i, (good, poor) in enumerate(counts):
        # Above the mean of the binomial the tail is never small: the sum stays short of the bound.
        if good > rate * n_good or tail(int(good), n_good, rate) > level:
            break
        if poor > most:
            best, most = i, int(poor)
    return best


def holdout(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id", target: str = "quality") -> DataFrame:
    """Signals of the labelled rows that pass the base conditions, with ``good`` 1 or 0.

    Ids with different marks, or standing on rows of different signals, and
    null marks or ids are left out; repeated rows count once.
    """
    marks = (labels.where(F.col(target).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias(id_col))
             .agg(F.min(target).alias("lo"), F.max(target).alias("hi")).where("lo = hi and lo in (0, 1)")
             .select(id_col, F.col("lo").cast("int").alias("good")))
    one = rows.join(marks, id_col).groupBy(id_col, "good").agg(
        F.min(F.struct("stratum", *SIGNALS)).alias("s"), F.max(F.struct("stratum", *SIGNALS)).alias("t")).where("s = t")
    return one.select("good", "s.*").where(~F.expr(BASE_FAILED))


def cutoffs(held: DataFrame, p: RiskParams = RiskParams()) -> DataFrame:
    """Per stratum a cutoff for every rule, null where none is certified: ``(stratum, *rule names)``.

    Spark counts, per stratum, rule and grid place, the good and poor rows that
    are first rejected there: a few hundred rows a stratum reach its group. The
    number of strata is all that the driver gets.
    """
    n_strata = held.where("good = 1").agg(F.count_distinct("stratum")).first()[0]
    tests = len(p.rules) * max(n_strata, 1)
    places = [F.struct(F.lit(k).alias("rule"), r.place().alias("place")) for k, r in enumerate(p.rules)]
    counted = (held.select("stratum", "good", F.explode(F.array(*places)).alias("x"))
               .groupBy("stratum", F.col("x.rule").alias("rule"), F.col("x.place").alias("place"))
               .agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("poor")))
    names = [r.name for r in p.rules]

    def decide(part: pd.DataFrame) -> pd.DataFrame:
        row = {"stratum": part["stratum"].iloc[0]}
        for k, r in enumerate(p.rules):
            at = np.zeros((len(r.grid) + 1, 2), np.int64)
            mine = part[part["rule"] == k]
            at[mine["place"].to_numpy()] = mine[["good", "poor"]].to_numpy()
            i = choose(at.cumsum(0)[:-1], int(at[:, 0].sum()), p.max_false_rejection / len(p.rules), p.delta / tests)
            row[r.name] = None if i is None else r.grid[i]
        return pd.DataFrame([row]).astype({n: "Int64" for n in names})

    return (counted.groupBy("stratum")
            .applyInPandas(decide, f"stratum string, {', '.join(f'{n} long' for n in names)}"))


def filtered(docs: DataFrame, labels: DataFrame, p: RiskParams = RiskParams(), id_col: str = "doc_id", text_col: str = "text",
             stratum_col: str = "lang") -> DataFrame:
    """Per row ``(id_col, *signals, base_failed, kept, failed_rules)``.

    Null and empty texts have no words and fail the base. Ties: a value equal
    to a cutoff is kept. Repeated rows, and null ids, come out each; a stratum
    without enough labelled rows has no cutoffs, so only the base rejects
    there. Other columns are not read. An empty table gives no rows.
    """
    rows = materialize(signals(docs, id_col, text_col, stratum_col))
    cuts = materialize(cutoffs(materialize(holdout(rows, labels, id_col)), p))
    at = [cuts[r.name].alias(f"__{r.name}") for r in p.rules]
    cuts = cuts.select("stratum", *at)
    if fits_broadcast(cuts, p.broadcast_rows, 64 << 20):
        met = rows.join(F.broadcast(cuts), "stratum", "left")
    else:
        met = salted_left_join(rows, cuts, ["stratum"], [id_col], p.salts)
    failed = F.filter(F.array(*[F.when(r.rejects(F.col(f"__{r.name}")), F.lit(r.name)) for r in p.rules]), lambda x: x.isNotNull())
    return (met.withColumn("failed_rules", failed).withColumn("base_failed", F.expr(BASE_FAILED))
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
            .select(id_col, *SIGNALS, "base_failed", "kept", F.concat_ws(",", "failed_rules").alias("failed_rules")))


def oracle(p: RiskParams = RiskParams()) -> str:
    """The same in DuckDB SQL, from the definitions, over ``documents`` and ``labels``."""
    grid = ", ".join(f"({k}, {i}, {c})" for k, r in enumerate(p.rules) for i, c in enumerate(r.grid))
    div = {r.name: r.value.replace(" div ", " // ") for r in p.rules}
    values = ", ".join(f"({k}, {div[r.name]}, {str(r.above).lower()})" for k, r in enumerate(p.rules))
    rate, level = p.max_false_rejection / len(p.rules), p.delta / len(p.rules)
    names = ", ".join(f"({k}, '{r.name}')" for k, r in enumerate(p.rules))
    return rf"""
with texts as (
  select row_number() over () as r, doc_id, coalesce(lang, '') as stratum, coalesce(text, '') as text from documents),
words as (
  select r, unnest(w) as word, generate_subscripts(w, 1) as pos from (
    select r, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from texts)),
windows as (
  select r, pos, word, lead(word) over o as w2, lead(word, 2) over o as w3 from words window o as (partition by r order by pos)),
twice as (
  select r, pos from (select r, pos, count(*) over (partition by r, word, w2, w3) as n from windows where w3 is not null) where n > 1),
covered as (select r, count(distinct pos + k) as n from twice, range(3) t(k) group by r),
lengths as (select r, count(*) as n_words, sum(length(word)) as word_chars from words group by r),
lines as (
  select r, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines
  from (select r, unnest(string_split(text, chr(10))) as line from texts) where regexp_matches(line, '[^\x20\x09-\x0D]') group by r),
signals as (
  select r, doc_id, stratum, coalesce(n_words, 0)::bigint as n_words, coalesce(word_chars, 0)::bigint as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, coalesce(n_lines, 0)::bigint as n_lines,
         coalesce(n_dup_lines, 0)::bigint as n_dup_lines, coalesce(covered.n, 0)::bigint as n_repeat_words
  from texts left join lengths using (r) left join lines using (r) left join covered using (r)),
based as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from signals),
marks as (select doc_id, min(quality) as good from labels where quality is not null group by doc_id having min(quality) = max(quality)),
held as (
  select any_value(b.r) as r, any_value(stratum) as stratum, any_value(good) as good from based b join marks using (doc_id)
  where good in (0, 1) group by doc_id
  having count(distinct (stratum, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words)) = 1 and not bool_or(base_failed)),
grid(rule, place, cutoff) as (values {grid}),
valued as (select s.r, v.rule, v.val, v.above from signals s, lateral (values {values}) v(rule, val, above)),
counted as (
  select stratum, g.rule, place, cutoff, sum(good) filter (case when above then val > cutoff else val < cutoff end) as good,
         sum(1 - good) filter (case when above then val > cutoff else val < cutoff end) as poor, sum(good) as n
  from held join valued using (r) join grid g using (rule) group by all),
tested as (
  select *, coalesce(good, 0) <= {rate} * n and n > 0 and (
           select sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({rate}) + (n - i) * ln(1 - {rate})))
           from range(0, coalesce(good, 0)::bigint + 1) t(i)) <= {level} / (select count(distinct stratum) from held where good = 1) as passed
  from counted),
certified as (
  select * from (select *, bool_and(passed) over (partition by stratum, rule order by place) as ok from tested) where ok and poor > 0),
chosen as (select stratum, rule, arg_max(cutoff, (poor, -place)) as cutoff from certified group by stratum, rule),
failed as (
  select r, string_agg(name, ',' order by rule) as failed_rules
  from signals join chosen using (stratum) join valued using (r, rule) join (values {names}) x(rule, name) using (rule)
  where case when above then val > cutoff else val < cutoff end group by r)
select doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and failed_rules is null as kept, coalesce(failed_rules, '') as failed_rules
from based left join failed using (r)
"""
