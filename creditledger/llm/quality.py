"""Quality rules: rules vote or abstain, and a label model weighs the votes.

Each rule votes good, votes bad or abstains on a document.  Rules are taken to err
independently, each with its own rates of the three votes on good and on bad documents.
Expectation-maximisation over all documents that pass the base test estimates these rates and
the share of good documents, and gives each document the posterior probability of being good.
The model only sees which votes a document got, and there are at most 3 to the power of the
number of rules such patterns, so one aggregate over the documents makes a table of bounded
size, and the iterations run over that table.

Built-in expressions only: no UDF, no pandas, no RDD.

Defined results: a null or empty text has no words and fails the base test.  Equal documents
get equal results.  An empty table gives an empty table.  Null ids are kept.  Other columns
are left alone; working columns are named ``_quality_...``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, cut, let, read, words_of

MIN_WORDS = 50
MOST_REPEATED_PERCENT = 50
#: Characters of regular-expression classes.
SYMBOLS = "#*$%&|<>"
CAPITALS = "A-ZÀ-ÖØ-Þ"
MARKS = "!?"
#: Frequent function words of English, German, French and Spanish.
FUNCTION_WORDS = (
    "the of and to in is that for with as be by on are this "
    "der die und den von zu das mit sich des ist im dem nicht ein "
    "le la les et du un une est que qui dans pour sur pas au "
    "el los las en por con para del se lo como su"
).split()
START_PRIOR = 0.9
#: Starting rates of the votes bad, none and good of any rule, on good and on bad documents.
START_RATES_GOOD = [0.01, 0.15, 0.84]
START_RATES_BAD = [0.25, 0.15, 0.6]
#: Weight of the starting values against the documents, in documents: estimates from few
#: documents stay near them, and no rate becomes zero.
START_DOCS = 5.0
ITERATIONS = 25
KEEP_AT = 0.5


def _count(text: Column, characters: str) -> Column:
    """Number of characters of a class; the class is a regular expression's."""
    return F.length(text) - F.length(F.regexp_replace(text, f"[{characters}]+", ""))


def repeated_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more, each word counted once.

    A window's key is 32 bits of its hash above its place.  Sorted, windows that may be equal
    are neighbours; only those are spelled out, sorted with their places and compared, so that
    the count is exact and no window is compared with all others.
    """

    def spelled(words: Column, i: Column) -> Column:
        three = F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
        return F.struct(three.alias("w"), i.alias("i"))

    def key(words: Column, i: Column) -> Column:
        hashed = F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
        return F.shiftleft(hashed, 32).bitwiseOR(i.cast("bigint"))

    def same_as_neighbour(rows: Column, j: Column, of) -> Column:
        own = of(F.get(rows, j))
        return own.eqNullSafe(of(F.get(rows, j - 1))) | own.eqNullSafe(of(F.get(rows, j + 1)))

    def candidates(keys: Column) -> Column:
        high = lambda k: F.shiftright(k, 32)
        low = lambda j: F.get(keys, j).bitwiseAND(F.lit(0xFFFFFFFF))
        at = F.filter(
            F.sequence(F.lit(0), F.size(keys) - 1), lambda j: same_as_neighbour(keys, j, high)
        )
        return F.transform(at, lambda j: low(j).cast("int"))

    def covered(windows: Column) -> Column:
        at = F.filter(
            F.sequence(F.lit(0), F.size(windows) - 1),
            lambda j: same_as_neighbour(windows, j, lambda x: x["w"]),
        )
        starts = F.transform(at, lambda j: F.get(windows, j)["i"])

        def union(starts: Column) -> Column:
            second = F.transform(starts, lambda i: i + 1)
            third = F.transform(starts, lambda i: i + 2)
            return F.size(F.array_union(F.array_union(starts, second), third))

        return let(starts, union)

    def body(words: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(words) - 3)
        keys = F.sort_array(F.transform(every, lambda i: key(words, i)))

        def exact(at: Column) -> Column:
            windows = F.sort_array(F.transform(at, lambda i: spelled(words, i)))
            return F.when(F.size(at) < 2, 0).otherwise(let(windows, covered))

        return F.when(F.size(words) < 3, 0).otherwise(let(let(keys, candidates), exact))

    return let(words, body)


def measures(text: Column) -> Column:
    """A struct of the counts that rules look at, all long."""
    plain = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(plain, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")

    def of_words(words: Column) -> Column:
        def is_function_word(word: Column) -> Column:
            return F.lower(word).isin(FUNCTION_WORDS)

        def ends_sentence(word: Column) -> Column:
            return F.substring(word, -1, 1).isin(".", "!", "?")

        counts = {
            "n_words": F.size(words),
            "word_chars": F.length(F.concat_ws("", words)),
            "n_symbols": _count(plain, SYMBOLS),
            "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
            "n_repeat_words": repeated_words(words),
            "n_function_words": F.size(F.filter(words, is_function_word)),
            "n_sentence_ends": F.size(F.filter(words, ends_sentence)),
            "n_capitals": _count(plain, CAPITALS),
            "n_marks": _count(plain, MARKS),
        }
        return F.struct(*[value.cast("bigint").alias(name) for name, value in counts.items()])

    return let(words_of(text), of_words)


def rules(m: Column | Mapping[str, Column]) -> dict[str, tuple[Column, Column]]:
    """For each rule, when it votes good and when it votes bad; else it abstains.

    Comparisons are between integers, so that no rounding decides.
    """
    n, chars = m["n_words"], m["word_chars"]
    return {
        "symbols": (m["n_symbols"] * 50 < chars, m["n_symbols"] * 12 > chars),
        "repeats": (m["n_repeat_words"] * 10 < n, m["n_repeat_words"] * 10 > n * 3),
        "capitals": (m["n_capitals"] * 8 < chars, m["n_capitals"] * 2 > chars),
        "function_words": (m["n_function_words"] * 12 > n, m["n_function_words"] * 50 < n),
        "word_length": (
            (chars >= n * 3) & (chars <= n * 10),
            (chars < n * 2) | (chars > n * 14),
        ),
        "sentence_ends": (
            (m["n_sentence_ends"] * 60 > n) & (m["n_sentence_ends"] * 3 < n),
            m["n_sentence_ends"] * 2 > n,
        ),
        "marks": (m["n_marks"] * 20 < n, m["n_marks"] * 2 > n),
        "duplicate_lines": (m["n_dup_lines"] * 100 < n, m["n_dup_lines"] * 10 > n),
    }


RULES = (
    "symbols repeats capitals function_words word_length sentence_ends marks duplicate_lines"
).split()


def votes(m: Column | Mapping[str, Column]) -> Column:
    """The votes in the order of ``RULES``, each as a number of its own.

    Rule ``j`` gives ``3 j`` for bad, ``3 j + 1`` for abstaining and ``3 j + 2`` for good, the
    places of the vote's rates in the model.
    """
    by_name = rules(m)
    cast = [
        F.when(by_name[name][0], 3 * j + 2).when(by_name[name][1], 3 * j).otherwise(3 * j + 1)
        for j, name in enumerate(RULES)
    ]
    return F.array(*cast)


def posterior(vote: Column, model: Column) -> Column:
    """Probability of good, given the votes."""

    def plus(total: Column, k: Column) -> Column:
        return total + F.log(F.get(model["good"], k) / F.get(model["bad"], k))

    score = F.aggregate(vote, F.log(model["prior"] / (1 - model["prior"])), plus)
    return 1 / (1 + F.exp(-score))


def start_model(n_rules: int) -> Column:
    rates = {"good": START_RATES_GOOD * n_rules, "bad": START_RATES_BAD * n_rules}
    lists = [F.array(*[F.lit(x) for x in r]).alias(name) for name, r in rates.items()]
    return F.struct(F.lit(START_PRIOR).alias("prior"), *lists)


def label_model(patterns: DataFrame, n_rules: int, iterations: int = ITERATIONS) -> DataFrame:
    """Expectation-maximisation over (votes, n): one row ``model`` of prior and vote rates.

    All patterns, at most 3 ** n_rules, are gathered into one array, in a fixed order so that
    sums repeat exactly, and the iterations fold over it inside one expression.  The starting
    values count as ``START_DOCS`` further documents of each kind.
    """

    def total(rows: Column, value) -> Column:
        return F.aggregate(rows, F.lit(0.0), lambda s, r: s + value(r))

    def step(rows: Column, model: Column) -> Column:
        def rated(r: Column) -> Column:
            good = r["n"] * posterior(r["votes"], model)
            return F.struct(r["votes"].alias("votes"), good.alias("g"), (r["n"] - good).alias("b"))

        def update(rows: Column) -> Column:
            good, bad = total(rows, lambda r: r["g"]), total(rows, lambda r: r["b"])

            def rates(side: str, whole: Column, start: list[float]) -> Column:
                begins = F.array(*[F.lit(x * START_DOCS) for x in start])

                def rate(k: Column) -> Column:
                    cast = F.filter(rows, lambda r: F.array_contains(r["votes"], k))
                    own = F.get(begins, F.pmod(k, F.lit(3)))
                    return (total(cast, lambda r: r[side]) + own) / (whole + START_DOCS)

                places = F.sequence(F.lit(0), F.lit(3 * n_rules - 1))
                return F.transform(places, rate)

            prior = (good + START_PRIOR * START_DOCS) / (good + bad + START_DOCS)
            return F.struct(
                prior.alias("prior"),
                rates("g", good, START_RATES_GOOD).alias("good"),
                rates("b", bad, START_RATES_BAD).alias("bad"),
            )

        return let(F.transform(rows, rated), update)

    row = F.struct(F.col("votes"), F.col("n").cast("double").alias("n"))
    gathered = patterns.agg(F.sort_array(F.collect_list(row)).alias("rows"))
    rounds = F.sequence(F.lit(1), F.lit(iterations))
    fitted = F.aggregate(rounds, start_model(n_rules), lambda m, _: step(F.col("rows"), m))
    return gathered.select(fitted.alias("model"))


def base_failed(m: Column | Mapping[str, Column]) -> Column:
    repeated = m["n_repeat_words"] * 100 > m["n_words"] * MOST_REPEATED_PERCENT
    return (m["n_words"] < MIN_WORDS) | repeated


def fit(measured: DataFrame, m: Column) -> DataFrame:
    """The label model of all documents that pass the base test."""
    cast = measured.select(votes(m).alias("votes"), base_failed(m).alias("failed"))
    patterns = cast.groupBy("votes", "failed").agg(F.count(F.lit(1)).alias("n"))
    return label_model(patterns.filter(~F.col("failed")).select("votes", "n"), len(RULES))


def judged(measured: DataFrame, m: Column, model: DataFrame) -> DataFrame:
    """``measured`` with ``_quality``: the counts, ``base_failed``, ``posterior``, ``kept``.

    The model is one row, joined by broadcast.
    """
    one = model.select(F.col("model").alias("_quality_model"))
    good = posterior(votes(m), F.col("_quality_model"))
    failed = base_failed(m)
    whole = m.withField("base_failed", failed).withField("posterior", good)
    whole = whole.withField("kept", ~failed & (good >= KEEP_AT))
    joined = measured.join(F.broadcast(one))
    return joined.withColumn("_quality", whole).drop("_quality_model")


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass the base test and that the label model holds for good.

    The texts are measured once: the rows are written with their measures, of which the model
    then reads no more than those, and only counts of vote patterns are shuffled.
    """
    m = F.col("_quality_m")
    measured = cut(docs.withColumn("_quality_m", measures(F.col(text))))
    rows = judged(measured, m, cut(fit(measured.select("_quality_m"), m)))
    return rows.filter(F.col("_quality.kept")).drop("_quality", "_quality_m")


def rate(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``id_column`` and the counts and verdict of ``_quality``."""
    measured = cut(docs.select(F.col(id_column), measures(F.col(text)).alias("_quality_m")))
    m = F.col("_quality_m")
    return judged(measured, m, fit(measured, m)).select(id_column, "_quality.*")


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = rate(read(spark, sf_dir, "documents"))
    return rated.select("doc_id", *COUNTS, "base_failed", "kept")


def _quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _iteration(t: int, n_places: int) -> str:
    """One round of the label model over the table ``patterns``, from model t - 1 to model t."""
    s = START_DOCS
    good, bad = ([s * x for x in rates] for rates in (START_RATES_GOOD, START_RATES_BAD))
    return f"""
), e{t} AS MATERIALIZED (
  SELECT votes, n, n / (1 + exp(-(ln(prior / (1 - prior))
         + list_sum(list_transform(votes, lambda k: ln(good[k + 1] / bad[k + 1])))))) AS g
  FROM patterns, m{t - 1}
), s{t} AS MATERIALIZED (
  SELECT k, sum(g) AS g, sum(n - g) AS b FROM (SELECT unnest(votes) AS k, n, g FROM e{t}) GROUP BY k
), t{t} AS MATERIALIZED (SELECT coalesce(sum(g), 0) AS g, coalesce(sum(n - g), 0) AS b FROM e{t}
), m{t} AS MATERIALIZED (
  SELECT any_value((t.g + {START_PRIOR * s}) / (t.g + t.b + {s})) AS prior,
         list((coalesce(x.g, 0) + {good}[p.k % 3 + 1]) / (t.g + {s}) ORDER BY p.k) AS good,
         list((coalesce(x.b, 0) + {bad}[p.k % 3 + 1]) / (t.b + {s}) ORDER BY p.k) AS bad
  FROM range({n_places}) AS p(k) LEFT JOIN s{t} AS x ON x.k = p.k CROSS JOIN t{t} AS t"""


def op8_sql() -> str:
    n_places = 3 * len(RULES)
    rounds = "".join(_iteration(t, n_places) for t in range(1, ITERATIONS + 1))
    start_good = [float(x) for x in START_RATES_GOOD * len(RULES)]
    start_bad = [float(x) for x in START_RATES_BAD * len(RULES)]
    return rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), windows AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM texts)
), repeated AS (
  SELECT r, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS place
        FROM windows JOIN (SELECT r, w FROM windows GROUP BY r, w HAVING count(*) > 1) USING (r, w))
  GROUP BY r
), measured AS (
  SELECT r, doc_id, len(words) AS n, length(array_to_string(words, '')) AS chars,
         length(text) - length(regexp_replace(text, '[{SYMBOLS}]', '', 'g')) AS symbols,
         length(text) - length(regexp_replace(text, '[{CAPITALS}]', '', 'g')) AS capitals,
         length(text) - length(regexp_replace(text, '[{MARKS}]', '', 'g')) AS marks,
         len(list_filter(words, lambda x: lower(x) IN ({_quoted(FUNCTION_WORDS)}))) AS functions,
         len(list_filter(words, lambda x: right(x, 1) IN ('.', '!', '?'))) AS ends,
         list_filter(string_split(text, chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         coalesce(n_repeat_words, 0) AS repeats
  FROM texts LEFT JOIN repeated USING (r)
), counted AS (
  SELECT *, len(lines) - len(list_distinct(lines)) AS dups,
         n < {MIN_WORDS} OR 100 * repeats > {MOST_REPEATED_PERCENT} * n AS base_failed
  FROM measured
), voted AS (
  SELECT *, list_transform([
      CASE WHEN symbols * 50 < chars THEN 2 WHEN symbols * 12 > chars THEN 0 ELSE 1 END,
      CASE WHEN repeats * 10 < n THEN 2 WHEN repeats * 10 > n * 3 THEN 0 ELSE 1 END,
      CASE WHEN capitals * 8 < chars THEN 2 WHEN capitals * 2 > chars THEN 0 ELSE 1 END,
      CASE WHEN functions * 12 > n THEN 2 WHEN functions * 50 < n THEN 0 ELSE 1 END,
      CASE WHEN chars >= n * 3 AND chars <= n * 10 THEN 2
           WHEN chars < n * 2 OR chars > n * 14 THEN 0 ELSE 1 END,
      CASE WHEN ends * 60 > n AND ends * 3 < n THEN 2 WHEN ends * 2 > n THEN 0 ELSE 1 END,
      CASE WHEN marks * 20 < n THEN 2 WHEN marks * 2 > n THEN 0 ELSE 1 END,
      CASE WHEN dups * 100 < n THEN 2 WHEN dups * 10 > n THEN 0 ELSE 1 END
    ], lambda v, j: 3 * (j - 1) + v) AS votes
  FROM counted
), patterns AS MATERIALIZED (
  SELECT votes, count(*)::DOUBLE AS n FROM voted WHERE NOT base_failed GROUP BY votes
), m0 AS (
  SELECT {START_PRIOR}::DOUBLE AS prior, {start_good}::DOUBLE[] AS good,
         {start_bad}::DOUBLE[] AS bad{rounds}
)
SELECT doc_id, n::BIGINT AS n_words, chars::BIGINT AS word_chars, symbols::BIGINT AS n_symbols,
       dups::BIGINT AS n_dup_lines, repeats::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND 1 / (1 + exp(-(ln(prior / (1 - prior))
         + list_sum(list_transform(votes, lambda k: ln(good[k + 1] / bad[k + 1]))))))
         >= {KEEP_AT} AS kept
FROM voted, m{ITERATIONS}
"""


OP8_SQL = op8_sql()
