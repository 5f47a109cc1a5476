"""Quality rules as a short-circuit cascade, ordered by what each rule rejects for its cost."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS

WINDOW = 8
#: Rows on which costs and selectivities are estimated; they change the order of the rules, never a verdict.
SAMPLE_ROWS = 500
BLANK_RUN = r"[ \t\n\x0B\f\r]+"
# Characters that count as symbols.
SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """A rule rejects a row when `fails` holds; `fails` may use the columns of features()."""

    name: str
    fails: str


# The thresholds of the production rules.
BASE_RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_words", "100 * n_repeat_words > 30 * n_words"),
)
RULES = (
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 15 * n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule("stutter", "10 * n_stutter > 3 * n_words"),
    Rule("capitals", r"2 * regexp_count(text, '\\p{Lu}') > regexp_count(text, '\\p{L}')"),
    Rule("exclamations", "2 * regexp_count(text, '[!?]') > n_words"),
    Rule("few_letters", r"10 * regexp_count(text, '\\p{L}') < 6 * word_chars"),
)


def features(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole: bool = False) -> DataFrame:
    """(row, text, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_stutter, n_repeat_words, place), one
    row per input row; `row` holds its id, or with `whole` all its columns, and `place` numbers the rows.

    Words end at ASCII white space. A null text counts as one without words: every count is 0. Lines
    without a word do not count. n_stutter counts words equal to the one before. n_repeat_words counts
    the words inside windows of WINDOW words that occur twice or more in the text, the first included;
    windows are compared by 64-bit hashes. All of it is evaluated row by row without a shuffle, so
    hot, null or repeated ids do not matter; an empty table gives no rows.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns] if whole else [F.col(f"`{id_col}`")])
    rows = df.select(row.alias("row"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("bare", F.btrim("text", F.lit(BLANKS)))
    rows = rows.withColumn("words", F.when(F.col("bare") == "", F.expr("cast(array() as array<string>)")).otherwise(F.split("bare", BLANK_RUN)))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    rows = rows.select("row", "text", "words", lines.alias("lines"), F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    last = F.size("hashes") - WINDOW + 1
    windows = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice("hashes", i, WINDOW)))
    rows = rows.select(
        "row",
        "text",
        F.size("words").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.expr("cast(size(filter(hashes, (h, i) -> h = get(hashes, i - 1))) as bigint)").alias("n_stutter"),
        F.when(last > 1, windows).alias("windows"),
    )
    repeats = F.size("windows") > F.size(F.array_distinct("windows"))
    pairs = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    rows = rows.withColumn("sorted", F.when(repeats, F.sort_array(pairs))).drop("windows")
    # `sorted` is used several times below, so it stays a column of its own and is computed once a row.
    again = F.expr("filter(sorted, (x, k) -> x.h = get(sorted, k - 1).h or x.h = get(sorted, k + 1).h)")
    rows = rows.withColumn("at", F.when(F.col("sorted").isNotNull(), F.sort_array(F.transform(again, lambda x: x["i"])))).drop("sorted")
    covered = F.expr(
        f"aggregate(at, named_struct('last', 0, 'n', 0L), "
        f"(a, p) -> named_struct('last', p + {WINDOW}, 'n', a.n + p + {WINDOW} - greatest(a.last, p)), a -> a.n)"
    )
    rows = rows.withColumns({"n_repeat_words": F.coalesce(covered, F.lit(0).cast("bigint")), "place": F.monotonically_increasing_id()})
    return rows.drop("at")


def rank_rules(sample: DataFrame, rules: tuple[Rule, ...]) -> list[Rule]:
    """The rules by rejected rows per second on a sample of features, the best first; ties by name.

    Only counts and seconds reach the driver. On an empty sample the order is that of the seconds.
    """
    total = sample.count()
    shares = sample.agg(*[F.count_if(F.expr(r.fails)).alias(r.name) for r in rules]).first()

    def seconds(condition: Column) -> float:
        start = time.perf_counter()
        sample.agg(F.count_if(condition)).collect()
        return time.perf_counter() - start

    floor = seconds(F.lit(False))
    cost = {r.name: max(1e-4, min(seconds(F.expr(r.fails)) for _ in range(2)) - floor) for r in rules}
    return sorted(rules, key=lambda r: (-(shares[r.name] / max(1, total)) / cost[r.name], cost[r.name], r.name))


def cascade(rules: list[Rule]) -> Column:
    """The name of the first rule in the order that rejects a row, or null; later rules are not evaluated."""
    verdict = None
    for rule in rules:
        fails = F.coalesce(F.expr(rule.fails), F.lit(False))
        verdict = F.when(fails, rule.name) if verdict is None else verdict.when(fails, rule.name)
    return F.lit(None).cast("string") if verdict is None else verdict


def judge(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    base_rules: tuple[Rule, ...] = BASE_RULES,
    rules: tuple[Rule, ...] = RULES,
    sample_rows: int = SAMPLE_ROWS,
    whole: bool = False,
) -> DataFrame:
    """features() with base_failed, kept and rejected_by (the rule that rejected a row first, or null).

    A row is kept when no base rule and no rule of the cascade rejects it; rules of equal rank on the
    sample may swap places, which can change rejected_by but not kept. An empty text fails few_words.
    """
    found = features(df, id_col, text_col, whole)
    # Raw rows are drawn before any feature is computed, and only what the rules read is kept.
    raw = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([id_col, text_col])])
    raw = raw.sample(min(1.0, 4 * sample_rows / max(1, df.count())), seed=1).limit(sample_rows)
    sample = features(raw, id_col, text_col).drop("row").persist()
    try:
        order = rank_rules(sample, rules)
    finally:
        sample.unpersist()
    base_failed = F.coalesce(cascade(list(base_rules)).isNotNull(), F.lit(False))
    judged = found.withColumn("base_failed", base_failed)
    named = F.when(F.col("base_failed"), F.lit("base")).otherwise(cascade(order))
    judged = judged.withColumn("rejected_by", named)
    return judged.withColumn("kept", F.col("rejected_by").isNull())


def drop_rejected(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of df, with all their columns, that judge() keeps."""
    judged = judge(df, id_col, text_col, whole=True)
    # A filter on the number stays above the features; pushed below, it would compute them for every use.
    return judged.filter("kept and place >= 0").select("row.*")
