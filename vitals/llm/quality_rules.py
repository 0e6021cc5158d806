"""Quality rules as a short-circuit cascade of native expressions.

Words are runs of characters other than ASCII white space. Four counts of a text
decide the base rule (too few words, too many words in repeated five-word
windows). The texts that pass it go through a cascade: a CASE whose branches are
tried in turn, so that a rejected text never pays for the later rules. Their
order comes from a sample: each rule is run alone on it for its cost, one count
by outcome gives every joint rejection, and the next rule is always the one that
rejects most of what the earlier ones left per unit of cost. A text is kept
if no rule rejects it, so the order moves only the work, never the verdict
(``reason`` names the first rule in that order that rejects).

Scale. One pass over the table without a shuffle, in JVM expressions only. The
sample has about ``sample_rows`` rows whatever the input, and only orders the rules.

Defined results: a null text has no words and fails the base rule, as an empty
one does; repeated rows get equal rows; a null ``doc_id`` is kept as it is; an
empty table gives no row; very long texts are taken whole.
"""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.llm.common import ASCII_SPACE, only, read, written

SAMPLE_ROWS = 2_000
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

_SPACES = r"[\x20\x09-\x0D]+"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also when lambdas use it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), _SPACES), lambda w: w != "")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window found twice or more in the text.

    Windows are compared by a 64-bit hash of the word hashes. Only a text in
    which some window repeats pays for the positions: sorted by (hash, place),
    repeated windows stand side by side, and their places, in order, cover
    ``window`` words each less what the one before covers already.
    """
    n = F.size(words)

    def windows(hashes: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(hashes) - window),
                           lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(window)]))

    def covered(hashed: Column) -> Column:
        by_hash = F.sort_array(F.transform(hashed, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        places = _let(by_hash, lambda s: F.transform(F.filter(
            s, lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"]))
        return _let(F.sort_array(places), lambda p: F.aggregate(
            F.transform(p, lambda at, k: F.least(F.lit(window), at - F.coalesce(F.get(p, k - 1), F.lit(-window)))),
            F.lit(0).cast("long"), lambda total, x: total + x))

    counted = _let(F.transform(words, lambda w: F.xxhash64(w)), lambda hashes: _let(windows(hashes), lambda w: F.when(
        F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(covered(w))))
    return F.when(n >= window, counted).otherwise(F.lit(0).cast("long"))


def with_counts(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with the words, the counts and the base rule."""
    bare = F.array_join("_words", "")
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(ASCII_SPACE)) != "")
    base = docs.withColumn("_words", words_of(F.col("text")))
    base = base.withColumns({
        "n_words": F.size("_words").cast("long"), "_bare": bare, "_lines": lines})
    base = base.withColumns({
        "word_chars": F.length("_bare").cast("long"),
        "n_symbols": F.length(F.regexp_replace("_bare", r"[^#*$%&|<>]+", "")).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": repeated_words(F.col("_words"))})
    return base.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                           | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def rules() -> dict[str, Column]:
    """Name -> condition under which the rule rejects a text that passed the
    base rule. Thresholds stand far from ordinary prose."""
    n = F.col("n_words")
    letters = F.length(F.regexp_replace("_bare", r"[^A-Za-zÀ-ɏ]+", ""))
    capitals = F.length(F.regexp_replace("_bare", r"[^\p{Lu}]+", ""))
    alphabetic = F.size(F.filter("_words", lambda w: w.rlike(r"\p{L}")))
    stutter = _let(F.col("_words"), lambda h: F.size(F.filter(h, lambda x, i: F.coalesce(F.get(h, i - 1) == x, F.lit(False)))))
    shouted = F.size(F.filter("_words", lambda w: w.endswith("!!")))
    return {
        "symbols": 10 * F.col("n_symbols") > n,
        "word_length": (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n),
        "repeated_lines": 2 * F.col("n_dup_lines") > F.size("_lines"),
        "stutter": 10 * stutter > 3 * n,
        "shouting": 2 * shouted > n,
        "capitals": (letters >= 20) & (2 * capitals > letters),
        "no_letters": 10 * alphabetic < 3 * n,
    }


def order(sample: DataFrame, conditions: Mapping[str, Column]) -> list[str]:
    """The rules by rejection per cost on ``sample`` (as ``with_counts`` gives it)."""
    cost = {}
    for name, condition in conditions.items():
        began = time.perf_counter()
        sample.select(F.count_if(condition)).collect()
        cost[name] = time.perf_counter() - began
    names = list(conditions)
    outcomes = [(r[:-1], r[-1]) for r in sample.where(~F.col("base_failed"))
                .groupBy(*[F.coalesce(conditions[k], F.lit(False)).alias(k) for k in names]).count().collect()]
    out: list[str] = []
    while len(out) < len(names):
        left = [(hit, n) for hit, n in outcomes if not any(hit[names.index(k)] for k in out)]
        rate = {k: sum(n for hit, n in left if hit[names.index(k)]) / cost[k] for k in names if k not in out}
        out.append(max(rate, key=lambda k: (rate[k], -cost[k])))
    return out


def cascade(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Column:
    """The CASE over columns of ``with_counts``: the rule that rejects, or null."""
    conditions = rules()
    share = min(1.0, sample_rows / max(1, docs.count()))  # rows of all parts, without a shuffle
    sample = written(with_counts(only(docs, doc_id="long", text="string").sample(share, 17)), "quality-sample")
    reason = F.when(F.col("base_failed"), F.lit("base"))
    for name in order(sample, conditions):
        reason = reason.when(conditions[name], F.lit(name))
    return reason


def judge(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` (doc_id, text) with the counts, ``base_failed``, ``reason`` (the
    first rule that rejects; null if none does) and ``kept``."""
    own = with_counts(only(docs, doc_id="long", text="string"))
    return own.withColumn("reason", cascade(docs, sample_rows)).withColumn("kept", F.col("reason").isNull())


def keep_good(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` whose text is kept, with their columns."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("text").cast("string").alias("text"))
    # a row number keeps the filter where it is: pushed below, it would compute the counts again for each rule
    judged = with_counts(row).withColumn("_reason", cascade(docs, sample_rows)).withColumn("_at", F.monotonically_increasing_id())
    return (judged.where(F.col("_reason").isNull() & (F.col("_at") >= 0))
            .select(*[F.col("_row").getField(c).alias(c) for c in docs.columns]))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


#: the counts and the rules over whole texts; a rule's place in the cascade changes no verdict
QUALITY_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
cut AS (
    SELECT r, doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
           list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM docs),
placed AS (SELECT r, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM cut),
near AS (
    SELECT r, i, w, lag(w) OVER o AS before,
           CASE WHEN lead(w, 4) OVER o IS NOT NULL
                THEN concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o) END AS g
    FROM placed WINDOW o AS (PARTITION BY r ORDER BY i)),
found AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM near WHERE g IS NOT NULL),
repeats AS (SELECT r, count(DISTINCT i + k) AS n FROM found, range(5) AS five(k) WHERE c > 1 GROUP BY r),
words AS (
    SELECT r, count(*) FILTER (w = before) AS stutter, count(*) FILTER (ends_with(w, '!!')) AS shouted,
           count(*) FILTER (regexp_matches(w, '\p{L}')) AS alphabetic
    FROM near GROUP BY r),
counted AS (
    SELECT r, doc_id, CAST(len(words) AS BIGINT) AS n_words, array_to_string(words, '') AS bare, len(lines) AS n_lines,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines
    FROM cut),
base AS (
    SELECT c.*, CAST(length(bare) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(bare, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
           length(regexp_replace(bare, '[^A-Za-zÀ-ɏ]+', '', 'g')) AS letters,
           length(regexp_replace(bare, '[^\p{Lu}]+', '', 'g')) AS capitals,
           CAST(coalesce(p.n, 0) AS BIGINT) AS n_repeat_words,
           coalesce(stutter, 0) AS stutter, coalesce(shouted, 0) AS shouted, coalesce(alphabetic, 0) AS alphabetic
    FROM counted c LEFT JOIN repeats p USING (r) LEFT JOIN words USING (r)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 2 * n_dup_lines > n_lines OR 10 * stutter > 3 * n_words OR 2 * shouted > n_words
            OR (letters >= 20 AND 2 * capitals > letters) OR 10 * alphabetic < 3 * n_words) AS kept
FROM judged
"""
