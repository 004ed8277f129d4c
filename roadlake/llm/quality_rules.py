"""Quality rules: decision lists learned by sequential covering and emitted as Spark conditional expressions."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.llm import common
from roadlake.llm.quality_model import sample_of
from roadlake.llm.statistics import BASE, MORE, RATIOS, ratios, statistics

STATS_SCHEMA = ", ".join(f"{x} long" for x in BASE + MORE)


@dataclass(frozen=True)
class Rule:
    """A conjunction of (ratio, ">" or "<=", threshold); a text that meets it is rejected."""

    terms: tuple[tuple[str, str, float], ...]

    def covers(self, x: np.ndarray) -> np.ndarray:
        hit = np.ones(len(x), bool)
        for name, op, bound in self.terms:
            column = x[:, RATIOS.index(name)]
            hit &= column > bound if op == ">" else column <= bound
        return hit

    def column(self) -> Column:
        out = F.lit(True)
        for name, op, bound in self.terms:
            ratio = ratio_columns()[name]
            out = out & ((ratio > bound) if op == ">" else (ratio <= bound))
        return out


def per(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


def ratio_columns() -> dict[str, Column]:
    """The same ratios as statistics.ratios, as Spark columns."""
    return {
        "symbols_per_word": per("n_symbols", "n_words"),
        "chars_per_word": per("word_chars", "n_words"),
        "dup_line_share": per("n_dup_lines", "n_lines"),
        "repeat_word_share": per("n_repeat_words", "n_words"),
        "distinct_share": per("n_distinct", "n_words"),
        "upper_share": per("n_upper", "n_chars"),
        "exclaims_per_word": per("n_exclaim", "n_words"),
        "digits_per_char": per("n_digits", "n_chars"),
        "words_per_line": per("n_words", "n_lines"),
        "words_per_stop": per("n_words", "n_stops"),
    }


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and a struct ``stats`` of BASE and MORE, for every whole text (null: no words)."""
    at, names = docs.columns.index(text), [*docs.columns, "stats"]
    kinds = pa.struct([(x, pa.int64()) for x in BASE + MORE])

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = np.array([statistics(t.as_py()) for t in batch.column(at)], np.int64).reshape(-1, len(kinds))
        stats = pa.StructArray.from_arrays([pa.array(rows[:, k].copy()) for k in range(len(kinds))], fields=list(kinds))
        return pa.RecordBatch.from_arrays([*batch.columns, stats], names=names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return common.map_columns(docs, one, f"{fields}, stats struct<{STATS_SCHEMA.replace(' long', ':long')}>")


def grow(x: np.ndarray, bad: np.ndarray, most: int = 4, cuts: int = 64) -> Rule | None:
    """Adds the term of the highest FOIL gain until no good text is covered. Thresholds lie midway between
    neighbouring values at ``cuts`` quantiles of the bad and of the good texts."""
    hit, terms = np.ones(len(x), bool), []
    while len(terms) < most and (hit & ~bad).any():
        p0, n0 = (hit & bad).sum(), (hit & ~bad).sum()
        best = (1e-9, None, None)
        for k, name in enumerate(RATIOS):
            column = x[:, k]
            values = np.unique(np.concatenate([np.quantile(column[hit & side], np.linspace(0, 1, cuts), method="nearest") for side in (bad, ~bad) if (hit & side).any()]))
            for bound in (values[1:] + values[:-1]) / 2:
                for op, side in ((">", column > bound), ("<=", column <= bound)):
                    p, n = (hit & side & bad).sum(), (hit & side & ~bad).sum()
                    if p and (gain := p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))) > best[0]:
                        best = (gain, (name, op, float(bound)), side)
        if best[1] is None:
            break
        terms.append(best[1])
        hit &= best[2]
    return Rule(tuple(terms)) if terms else None


def worth(rule: Rule, x: np.ndarray, bad: np.ndarray) -> float:
    hit = rule.covers(x)
    p, n = (hit & bad).sum(), (hit & ~bad).sum()
    return (p - n) / (p + n) if p + n else -1.0


def learn(x: np.ndarray, bad: np.ndarray, most: int = 12, precision: float = 0.9, seed: int = 0) -> list[Rule]:
    """Sequential covering: grow a rule on two thirds of what is left, prune its last terms while that does not make it
    worse on the other third, and take away what it covers. Ends when a rule is no more right than ``precision``
    there, or nothing bad is left."""
    rules: list[Rule] = []
    rng, left = np.random.default_rng(seed), np.ones(len(x), bool)
    while len(rules) < most and (left & bad).sum() >= 3:
        at = rng.permutation(np.flatnonzero(left))
        cut = len(at) * 2 // 3
        grown, held = at[:cut], at[cut:]
        rule = grow(x[grown], bad[grown]) if bad[grown].any() else None
        if rule is None:
            break
        while len(rule.terms) > 1 and worth(shorter := Rule(rule.terms[:-1]), x[held], bad[held]) >= worth(rule, x[held], bad[held]):
            rule = shorter
        hit = rule.covers(x)
        if worth(rule, x[held], bad[held]) < 2 * precision - 1 or not (hit & left & bad).any():
            break
        rules.append(rule)
        left &= ~hit
    return rules


def train(docs: DataFrame, labels: DataFrame, sample: int = 12_000) -> list[Rule]:
    """Learns from the statistics of at most ``sample`` labelled rows outside the held-out fold; the driver gets
    these numbers only. Of repeated rows of one id the least by its numbers counts. No labels, or labels of one kind,
    give no rules."""
    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    chosen = with_statistics(own.join(F.broadcast(sample_of(labels, sample)), "doc_id"))
    one = chosen.groupBy("doc_id").agg(F.min(F.struct("label", "stats.*")).alias("x"))
    got = one.select("doc_id", "x.*").toPandas().sort_values("doc_id")
    if got["label"].nunique() < 2:
        return []
    return learn(ratios(got[BASE + MORE].to_numpy()), got["label"].to_numpy() == 0)


def verdict(rules: list[Rule]) -> Column:
    """The decision list: the number of the first rule that a row of statistics meets (from 1), else 0 (kept)."""
    out: Column | None = None
    for k, rule in enumerate(rules):
        out = F.when(rule.column(), F.lit(k + 1)) if out is None else out.when(rule.column(), F.lit(k + 1))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def judged(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """doc_id, the base statistics, base_failed, kept, rule (the first that fired, 0: none): one row per row.

    Null and empty texts have no words and fail the base rules. Null doc_id stays null, repeated rows are judged each,
    an empty table gives no rows. Columns other than doc_id and text are not read.
    """
    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    stats = with_statistics(own).select("doc_id", "stats.*")
    return stats.select("doc_id", *BASE, base_failed().alias("base_failed"), verdict(rules).alias("rule")).withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def keep_good(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns; no join."""
    names = docs.columns
    own = [f"_own_{k}" for k in range(len(names))]
    stats = with_statistics(docs.toDF(*own), own[names.index("text")]).select(*own, "stats.*")
    return stats.where(~base_failed() & (verdict(rules) == 0)).select(*own).toDF(*names)
