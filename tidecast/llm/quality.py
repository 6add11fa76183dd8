"""Quality rules whose cutoffs carry a proven bound on false rejections.

Every rule is a number per text; a text is rejected if it lies above the rule's
cutoff for the text's stratum. Cutoffs come from labelled good texts: of a grid, the
strictest one for which the exact binomial test shows that at most ``max_rejected``
of the good texts of the stratum are rejected. The risk of any wrong cutoff is held
to ``risk`` over all rules, strata and grid points together (Bonferroni).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import query, table, written

BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"


@dataclass(frozen=True)
class Settings:
    """Grids hold each rule's cutoffs; ``max_rejected`` is shared by the rules."""

    max_rejected: float = 0.02
    risk: float = 0.05
    max_strata: int = 64
    grids: dict[str, tuple[float, ...]] = field(
        default_factory=lambda: {
            "symbols_per_word": (0.02, 0.05, 0.1, 0.2, 0.4, 0.8, 1.6),
            "dup_line_share": (0.05, 0.1, 0.2, 0.3, 0.5, 0.7),
            "repeat_share": (0.02, 0.05, 0.1, 0.2, 0.3, 0.4),
            "word_length_gap": (1.0, 1.5, 2.0, 3.0, 5.0, 10.0),
        }
    )

    @property
    def tests(self) -> int:
        """Cutoffs tried in each stratum."""
        return sum(len(g) for g in self.grids.values())


def with_counts(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``_row`` (a struct of the columns ``keep``), n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words and base_failed per row.

    Null is taken as empty text: all counts 0, base_failed true. The work on one text
    stays in its row: three-word windows are hashed, hashes sorted with their place in
    the low bits, and neighbours compared by full hash.
    """
    words = F.filter(
        F.split(F.coalesce(F.col(text), F.lit("")), BLANK), lambda w: w != F.lit("")
    )
    lines = F.filter(
        F.split(F.coalesce(F.col(text), F.lit("")), "\n"),
        lambda l: l.rlike(r"[^\x20\x09-\x0D]"),
    )
    step = docs.select(
        F.struct(*[docs[c] for c in keep]).alias("_row"),
        docs[text].alias("_t"),
        words.alias("_w"),
        lines.alias("_l"),
    )
    step = step.select(
        "_row",
        F.size("_w").cast("long").alias("_n"),
        F.length(F.array_join("_w", "")).cast("long").alias("_chars"),
        (
            F.length(F.coalesce("_t", F.lit("")))
            - F.length(F.regexp_replace(F.coalesce("_t", F.lit("")), SYMBOLS, ""))
        )
        .cast("long")
        .alias("_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("_dups"),
        F.filter(
            F.transform(
                F.col("_w"),
                lambda w, i: F.when(
                    i < F.size("_w") - 2,
                    F.xxhash64(w, F.get("_w", i + 1), F.get("_w", i + 2)),
                ),
            ),
            lambda h: h.isNotNull(),
        ).alias("_h"),
        F.length(F.bin(F.size("_w").cast("long"))).alias("_b"),
    )
    packed = F.sort_array(
        F.transform(
            F.col("_h"),
            lambda h, i: F.call_function("shiftleft", F.call_function("shiftright", F.coalesce(h, F.lit(0)), F.col("_b")), F.col("_b"))
            .bitwiseOR(i.cast("long")),
        )
    )
    step = step.withColumn("_s", packed)

    def full(x: Column) -> Column:
        low = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_b")) - 1
        return F.get("_h", x.bitwiseAND(low).cast("int"))

    def twin(x: Column, i: Column) -> Column:
        same = lambda y: F.coalesce(
            (F.call_function("shiftright", x, F.col("_b")) == F.call_function("shiftright", y, F.col("_b")))
            & (full(x) == full(y)),
            F.lit(False),
        )
        return same(F.get("_s", i - 1)) | same(F.get("_s", i + 1))

    low = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_b")) - 1
    places = F.sort_array(
        F.transform(F.filter(F.col("_s"), twin), lambda x: x.bitwiseAND(low))
    )
    step = step.withColumn("_p", places)
    covered = F.aggregate(
        F.transform(
            F.col("_p"),
            lambda p, i: F.least(F.lit(3).cast("long"), F.coalesce(F.get("_p", i + 1) - p, F.lit(3).cast("long"))),
        ),
        F.lit(0).cast("long"),
        lambda a, x: a + x,
    )
    step = step.withColumn("_r", covered)
    counts = F.struct(
        F.col("_n").alias("n_words"),
        F.col("_chars").alias("word_chars"),
        F.col("_symbols").alias("n_symbols"),
        F.col("_dups").alias("n_dup_lines"),
        F.col("_r").alias("n_repeat_words"),
        ((F.col("_n") < 50) | (100 * F.col("_r") > 50 * F.col("_n"))).alias("base_failed"),
    )
    # A generated row keeps later filters from being pushed into the expressions
    # above, which would split each text once per word.
    return step.select("_row", F.inline(F.array(counts)))



def signals() -> dict[str, Column]:
    """The rules as columns over the counts; larger is worse."""
    n = F.greatest(F.col("n_words"), F.lit(1).cast("long"))
    return {
        "symbols_per_word": F.col("n_symbols") / n,
        "dup_line_share": F.col("n_dup_lines") / (F.col("n_dup_lines") + F.col("n_words") / 20.0 + 1),
        "repeat_share": F.col("n_repeat_words") / n,
        "word_length_gap": F.abs(F.col("word_chars") / n - 5.5),
    }


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """Log of P(X <= k) for X binomial (n, p), by summing terms in log space."""
    first = n * F.log1p(F.lit(-p))
    odds = F.log(F.lit(p)) - F.log1p(F.lit(-p))
    start = F.struct(first.alias("term"), first.alias("total"))

    def add(acc: Column, j: Column) -> Column:
        term = acc["term"] + F.log((n - j + 1) / j) + odds
        high = F.greatest(acc["total"], term)
        total = high + F.log(F.exp(acc["total"] - high) + F.exp(term - high))
        return F.struct(term.alias("term"), total.alias("total"))

    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(
        F.array().cast("array<bigint>")
    )
    return F.aggregate(steps, start, add, lambda acc: acc["total"])


def cutoffs(
    counted: DataFrame, labels: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """One row per stratum: ``_stratum``, ``_known`` and a cutoff per rule (null: rule off).

    ``counted`` holds the counts by doc_id and stratum. Good texts are those of ``labels`` with
    quality 1 that the base rules keep; of several labels for a text each counts.
    Strata are the ``max_strata`` values with most good texts; the others share one.
    """
    good = (
        labels.where(F.col("quality") == 1)
        .select(F.col("doc_id").alias("_label"))
        .join(counted, F.col("_label") == F.col("doc_id"))
        .where(~F.col("base_failed"))
        .select(F.col("stratum").alias("_value"), *[c.alias(f"_x_{r}") for r, c in signals().items()])
    )
    over = [
        F.sum((F.col(f"_x_{rule}") > cut).cast("long")).alias(f"_k_{rule}_{i}")
        for rule, grid in settings.grids.items()
        for i, cut in enumerate(grid)
    ]
    by_value = written(
        good.groupBy("_value").agg(F.count(F.lit(1)).alias("_n"), *over), "quality-strata"
    )
    strata = min(settings.max_strata, by_value.where(F.col("_value").isNotNull()).count()) + 1
    ks = [c for c in by_value.columns if c.startswith("_k_")]
    top = by_value.where(F.col("_value").isNotNull()).orderBy(F.desc("_n"), "_value").limit(settings.max_strata)
    top = top.select(F.col("_value").alias("_stratum"), "_n", *ks)
    total = by_value.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ["_n", *ks]])
    named = top.agg(*[(-F.coalesce(F.sum(c), F.lit(0))).alias(c) for c in ["_n", *ks]])
    # What is in no named stratum is the difference of two totals.
    rest = total.unionByName(named).agg(*[F.sum(c).alias(c) for c in ["_n", *ks]])
    rest = rest.select(F.lit(None).cast("string").alias("_stratum"), "_n", *ks)
    allowed = settings.max_rejected / len(settings.grids)
    limit = F.log(F.lit(settings.risk / (strata * settings.tests)))
    chosen = [
        F.coalesce(
            *[
                F.when(
                    (F.col("_n") > 0) & (F.col(f"_k_{rule}_{i}") <= allowed * F.col("_n"))
                    & (binomial_tail(F.col(f"_k_{rule}_{i}"), F.col("_n"), allowed) <= limit),
                    F.lit(cut),
                )
                for i, cut in enumerate(grid)
            ],
            F.lit(None).cast("double"),
        ).alias(f"_c_{rule}")
        for rule, grid in settings.grids.items()
    ]
    return top.unionByName(rest).select("_stratum", *chosen)


def judged(counted: DataFrame, limits: DataFrame) -> DataFrame:
    """Add ``kept``: false for base failures and texts above a cutoff of their stratum."""
    # At most max_strata rows, so the broadcast is bounded; the shared stratum is one row.
    rest = limits.where(F.col("_stratum").isNull()).first()
    named = F.broadcast(limits.where(F.col("_stratum").isNotNull()).withColumn("_named", F.lit(True)))
    out = counted.join(named, counted["stratum"] == named["_stratum"], "left")
    bad = F.lit(False)
    for rule, value in signals().items():
        shared = F.lit(rest[f"_c_{rule}"]).cast("double")
        cut = F.when(F.col("_named"), F.col(f"_c_{rule}")).otherwise(shared)
        bad = bad | F.coalesce(value > cut, F.lit(False))
    return out.select(
        *[counted[c] for c in counted.columns], (~F.col("base_failed") & ~bad).alias("kept")
    )


def narrow_counts(docs: DataFrame, stratum: str) -> DataFrame:
    counted = with_counts(docs, ["doc_id", stratum])
    return counted.select(
        F.col("_row.doc_id").alias("doc_id"),
        F.col("_row")[stratum].cast("string").alias("stratum"),
        *[c for c in counted.columns if c != "_row"],
    )


def judge_quality(
    docs: DataFrame, labels: DataFrame, stratum: str = "lang", settings: Settings = Settings()
) -> DataFrame:
    """doc_id, stratum, the counts, base_failed and kept for every row of ``docs``.

    Rows with a null or repeated doc_id are judged like all others; a null stratum
    falls into the shared one. An empty label table switches all cutoffs off. Further
    columns of ``docs`` are left out.
    """
    counted = written(narrow_counts(docs, stratum), "quality-counts")
    limits = written(cutoffs(counted, labels, settings), "quality-cutoffs")
    return judged(counted, limits)


def keep_good(
    docs: DataFrame, labels: DataFrame, stratum: str = "lang", settings: Settings = Settings()
) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns of ``docs``."""
    limits = written(
        cutoffs(narrow_counts(docs, stratum), labels, settings), "quality-cutoffs"
    )
    counted = with_counts(docs, docs.columns).withColumn(
        "stratum", F.col("_row")[stratum].cast("string")
    )
    return judged(counted, limits).where(F.col("kept")).select("_row.*")


SETTINGS = Settings()


def _sql() -> str:
    """The same verdicts in SQL: windows as text, the binomial test by log-gamma."""
    x = {
        "symbols_per_word": "n_symbols / greatest(n_words, 1)",
        "dup_line_share": "n_dup_lines / (n_dup_lines + n_words / 20.0::double + 1)",
        "repeat_share": "n_repeat_words / greatest(n_words, 1)",
        "word_length_gap": "abs(word_chars / greatest(n_words, 1) - 5.5::double)",
    }
    allowed = SETTINGS.max_rejected / len(SETTINGS.grids)
    grid = ", ".join(
        f"('{r}', {c}::double)" for r, cuts in SETTINGS.grids.items() for c in cuts
    )
    values = " UNION ALL ".join(
        f"SELECT rid, '{rule}' AS rule, ({e})::double AS x FROM counted" for rule, e in x.items()
    )
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
l AS (SELECT rid, list_filter(string_split(text, chr(10)),
        lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT rid, unnest(range(1, len(w) - 1)) AS i, w FROM w WHERE len(w) > 2),
g2 AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS n FROM g),
r AS (SELECT rid, count(DISTINCT i + k)::bigint AS n FROM g2, (VALUES (0), (1), (2)) t(k)
      WHERE n > 1 GROUP BY rid),
counted AS (
  SELECT d.rid, d.doc_id, d.lang, len(w.w)::bigint AS n_words,
    length(regexp_replace(d.text, '[\x20\x09-\x0D]+', '', 'g'))::bigint AS word_chars,
    length(regexp_replace(d.text, '[^#*$%&|<>]+', '', 'g'))::bigint AS n_symbols,
    (len(l.l) - len(list_distinct(l.l)))::bigint AS n_dup_lines,
    coalesce(r.n, 0)::bigint AS n_repeat_words,
    (len(w.w) < 50 OR 100 * coalesce(r.n, 0) > 50 * len(w.w)) AS base_failed
  FROM d JOIN w USING (rid) JOIN l USING (rid) LEFT JOIN r USING (rid)),
x AS ({values}),
grid(rule, cut) AS (VALUES {grid}),
good AS (SELECT c.rid, c.lang FROM labels JOIN counted c USING (doc_id) WHERE quality = 1 AND NOT base_failed),
size AS (SELECT lang, count(*) AS n FROM good GROUP BY lang),
named AS (SELECT lang FROM size WHERE lang IS NOT NULL ORDER BY n DESC, lang LIMIT {SETTINGS.max_strata}),
strata AS (SELECT CASE WHEN lang IN (SELECT lang FROM named) THEN lang END AS s, good.rid FROM good),
k AS (SELECT s, rule, cut, count(*) AS n, count(*) FILTER (WHERE x > cut) AS k
      FROM strata JOIN x USING (rid) JOIN grid USING (rule) GROUP BY ALL),
cdf AS (SELECT s, rule, cut, (SELECT sum(exp(lgamma(n + 1.0) - lgamma(j + 1.0) - lgamma(n - j + 1.0)
          + j * ln({allowed}) + (n - j) * ln(1 - {allowed}))) FROM range(0, k + 1) t(j)) AS p
        FROM k WHERE k <= {allowed} * n),
cuts AS (SELECT s, rule, min(cut) AS cut FROM cdf
         WHERE p <= {SETTINGS.risk} / ((SELECT count(*) + 1 FROM named) * {SETTINGS.tests}) GROUP BY ALL),
bad AS (SELECT DISTINCT c.rid FROM counted c JOIN x USING (rid)
        JOIN cuts ON cuts.rule = x.rule AND cuts.s IS NOT DISTINCT FROM
          CASE WHEN c.lang IN (SELECT lang FROM named) THEN c.lang END
        WHERE x.x > cuts.cut)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  (NOT base_failed AND rid NOT IN (SELECT rid FROM bad)) AS kept
FROM counted"""


@query("op8_risk_controlled_quality", _sql())
def risk_controlled_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality verdicts on every document, cutoffs learned from all labels."""
    verdicts = judge_quality(
        table(spark, folder, "documents"), table(spark, folder, "labels"), settings=SETTINGS
    )
    return verdicts.drop("stratum")
