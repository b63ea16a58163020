"""Quality by weak supervision, in DataFrame operations only.

Each rule votes bad, good or abstains. All documents with the same votes are one pattern; there
are at most 3^rules patterns, so expectation-maximisation runs inside one SQL expression over the
counted patterns: it estimates how often each rule calls a bad and a good document bad, and the
share of bad documents. The base test is no rule and takes no part in the fit; a document that
passes it is kept unless its posterior of being bad exceeds a half. No label is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import need, numbered_names, set_aside, stored

WORD = r"[\x20\x09-\x0D]+"
SYMBOL, UPPER = "[#*$%&|<>]", "[A-ZÀ-ÖØ-Þ]"
# Frequent function words of English, German, French and Spanish.
STOPS = "a an and are as at by for from in is it of on or that the this to was with auf das dem den der des die ein eine ist im mit nicht sich und von zu au aux des du elle en est et la le les par pas pour qui sur un une con de del el es los no para por que se su".split()
# Marks that stand alone in lists and tables.
BARS = "| - * > • – — + =".split()
#: Name, votes bad when, votes good when; else it abstains. Both hold in Spark and in DuckDB. Each is
#: tight enough to err on good documents; how often it does is what the fit finds out.
RULES = [
    ("symbols", "20 * n_symbols > n_words", "100 * n_symbols <= n_words"),
    ("bars", "20 * n_bars > n_words", "100 * n_bars <= n_words"),
    ("casing", "100 * n_upper > 15 * word_chars", "100 * n_upper <= 8 * word_chars"),
    ("shouts", "20 * n_marks > n_words", "100 * n_marks <= n_words"),
    ("stops", "100 * n_stops < 15 * n_words", "100 * n_stops >= 25 * n_words"),
    ("lines", "10 * n_dup_lines > n_lines", "n_dup_lines = 0"),
    ("ends", "2 * n_ended < n_lines", "10 * n_ended >= 8 * n_lines"),
    ("length", "10 * word_chars < 35 * n_words or word_chars > 7 * n_words", "word_chars >= 4 * n_words and word_chars <= 6 * n_words"),
    ("spread", "n_spread < 4 * n_words * n_words or n_spread > 20 * n_words * n_words", "n_spread >= 6 * n_words * n_words and n_spread <= 15 * n_words * n_words"),
    ("variety", "10 * n_distinct < 5 * n_words", "10 * n_distinct >= 7 * n_words"),
]
#: Rounds of expectation-maximisation, first values of the estimates, and documents that the first values weigh as much as.
ROUNDS, WEIGHT = 30, 1
START = {"bad": 0.1, "hit": 0.4, "miss": 0.05}
#: The share of bad documents stays below a half, which tells bad from good; else bounds only keep logarithms finite.
BOUNDS = {"bad": (0.000001, 0.5), "hit": (0.000001, 0.999999), "miss": (0.000001, 0.999999)}
#: Counts that the rules use beside those of the base test.
EXTRA = ["n_lines", "n_bars", "n_upper", "n_marks", "n_stops", "n_ended", "n_distinct", "n_spread"]


def listed(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, EXTRA, base_failed, pattern.

    Null, empty and blank texts have no words and fail the base. Windows of five words are compared by a
    64-bit hash of the five. Long texts are taken whole, in a row of their own; repeated rows and
    ties count each; an empty table gives no rows. Other columns pass through, those of these names with an underscore in front.
    """
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *EXTRA, "base_failed", "pattern"]
    need(docs, text)
    docs, now = set_aside(docs, *made, "n_upper", "n_marks", "_text", "_words", "_lines", "_hashes", "_sorted", "_hits")
    text = now[text]
    out = docs.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    out = out.withColumns(
        {
            "_words": F.filter(F.split("_text", WORD), lambda x: x != ""),
            "_lines": F.filter(F.split("_text", "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]"))),
            "n_symbols": F.regexp_count("_text", F.lit(SYMBOL)).cast("long"),
            "n_upper": F.regexp_count("_text", F.lit(UPPER)).cast("long"),
            "n_marks": F.regexp_count("_text", F.lit("!")).cast("long"),
        }
    )
    out = out.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "_squares": F.expr("aggregate(_words, 0L, (a, w) -> a + length(w) * length(w))"),
            "n_distinct": F.size(F.array_distinct("_words")).cast("long"),
            "n_stops": F.expr(f"cast(size(filter(_words, w -> w in ({listed(STOPS)}))) as long)"),
            "n_bars": F.expr(f"cast(size(filter(_words, w -> w in ({listed(BARS)}))) as long)"),
            "n_lines": F.size("_lines").cast("long"),
            "n_ended": F.expr("cast(size(filter(_lines, x -> substr(rtrim(x), -1) in ('.', '!', '?'))) as long)"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_hashes": F.expr("if(size(_words) < 5, array(), transform(sequence(0, size(_words) - 5), i -> xxhash64(_words[i], _words[i + 1], _words[i + 2], _words[i + 3], _words[i + 4])))"),
        }
    ).drop("_words", "_lines")
    out = out.withColumn("n_spread", F.expr("n_words * _squares - word_chars * word_chars")).drop("_squares")
    out = out.withColumn("_sorted", F.expr("if(size(array_distinct(_hashes)) < size(_hashes), sort_array(transform(_hashes, (h, i) -> struct(h, i))), null)")).drop("_hashes")
    again = "(k > 0 and _sorted[greatest(k - 1, 0)].h = x.h) or (k < size(_sorted) - 1 and _sorted[least(k + 1, size(_sorted) - 1)].h = x.h)"
    out = out.withColumn("_hits", F.expr(f"sort_array(filter(transform(_sorted, (x, k) -> if({again}, x.i, -1)), i -> i >= 0))")).drop("_sorted")
    out = out.withColumn("n_repeat_words", F.expr("cast(if(_hits is null, 0, 5 + aggregate(transform(_hits, (x, k) -> if(k = 0, 0, least(5, x - _hits[greatest(k - 1, 0)]))), 0, (a, x) -> a + x)) as long)")).drop("_hits")
    out = out.withColumn("base_failed", F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words"))
    votes = [f"case when {bad} then 1 when {good} then 0 else 2 end" for _, bad, good in RULES]
    return out.withColumn("pattern", F.expr("concat(" + ", ".join(votes) + ")")).select(*docs.columns, *made)


def judged(patterns: DataFrame) -> DataFrame:
    """pattern, p_bad, fit: the posterior of each counted pattern (pattern, n) after ROUNDS rounds.

    fit: bad (share of bad documents), hit and miss (how often each rule that votes calls a bad,
    and a good document bad). No patterns give no rows.
    """
    r = len(RULES)

    def clamp(x: str, name: str) -> str:
        lo, hi = BOUNDS[name]
        return f"least({hi}D, greatest({lo}D, {x}))"

    def posterior(x: str, s: str) -> str:
        odds = f"aggregate(sequence(0, {r - 1}), ln((1 - {s}.bad) / {s}.bad), (a, j) -> a + case {x}.v[j] when 1 then ln({s}.miss[j] / {s}.hit[j]) when 0 then ln((1 - {s}.miss[j]) / (1 - {s}.hit[j])) else 0D end)"
        return f"1 / (1 + exp({odds}))"

    def rate(weight: str, name: str) -> str:
        part = lambda test: f"aggregate(e, 0D, (t, y) -> t + if(y.v[j] {test}, {weight}, 0D))"
        start = START[name] * WEIGHT
        return f"transform(sequence(0, {r - 1}), j -> {clamp(f'({part("= 1")} + {start}D) / ({part("< 2")} + {WEIGHT}D)', name)})"

    expected = f"transform(_all, x -> named_struct('v', x.v, 'n', x.n, 'w', x.n * {posterior('x', 's')}))"
    bad = clamp("aggregate(e, 0D, (t, y) -> t + y.w) / aggregate(e, 0D, (t, y) -> t + y.n)", "bad")
    step = f"transform(array({expected}), e -> named_struct('bad', {bad}, 'hit', {rate('y.w', 'hit')}, 'miss', {rate('y.n - y.w', 'miss')}))[0]"
    fill = lambda name: f"array_repeat({START[name]}D, {r})"
    state = f"aggregate(sequence(1, {ROUNDS}), named_struct('bad', {START['bad']}D, 'hit', {fill('hit')}, 'miss', {fill('miss')}), (s, i) -> {step})"
    votes = "transform(split(pattern, ''), c -> cast(c as int))"
    rows = patterns.select("pattern", F.expr(votes).alias("v"), F.col("n").cast("double").alias("n"))
    whole = rows.agg(F.sort_array(F.collect_list(F.struct("pattern", "v", "n"))).alias("_all")).where(F.size("_all") > 0)
    fitted = whole.select("_all", F.expr(state).alias("s"))
    return fitted.select(F.explode("_all").alias("x"), "s").select(F.col("x.pattern").alias("pattern"), F.expr(posterior("x", "s")).alias("p_bad"), F.col("s").alias("fit"))


def verdicts(rows: DataFrame) -> DataFrame:
    """Stored counted rows with p_bad and kept; the verdicts of the patterns (3^10 at most) are stored and broadcast."""
    found = judged(rows.groupBy("pattern").agg(F.count("*").alias("n"))).drop("fit")
    return rows.join(F.broadcast(stored(found, "verdicts")), "pattern").withColumn("kept", ~F.col("base_failed") & (F.col("p_bad") <= 0.5))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The kept rows of docs, with its columns, as ``counted`` and ``verdicts`` say.

    Texts are counted once: rows are stored with their votes. Repeated rows stay or go alike; null
    and empty texts go; an empty table gives no rows; other columns may have any name.
    """
    need(docs, text)
    plain, names = numbered_names(docs)
    rows = stored(counted(plain, names[text]).select(*plain.columns, "base_failed", "pattern"), "voted")
    return verdicts(rows).where("kept").select(*plain.columns).toDF(*docs.columns)


def table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the counts, base_failed, p_bad and kept of every row of docs, texts counted once.

    Null and repeated doc_ids pass through; each row is judged alone, by the fit over all rows.
    """
    return verdicts(stored(counted(docs.select(doc_id, text), text).drop(text), "quality"))


def sql() -> str:
    r = len(RULES)
    votes = ", ".join(f"CASE WHEN {bad} THEN 1 WHEN {good} THEN 0 ELSE 2 END AS v{j}" for j, (_, bad, good) in enumerate(RULES))
    names = ", ".join(f"v{j}" for j in range(r))

    def post(s: str) -> str:
        odds = " + ".join([f"ln((1 - {s}.bad) / {s}.bad)"] + [f"CASE p.v{j} WHEN 1 THEN ln({s}.miss{j} / {s}.hit{j}) WHEN 0 THEN ln((1 - {s}.miss{j}) / (1 - {s}.hit{j})) ELSE 0 END" for j in range(r)])
        return f"1 / (1 + exp({odds}))"

    def clamp(x: str, name: str) -> str:
        return f"least({BOUNDS[name][1]}, greatest({BOUNDS[name][0]}, {x}))"

    first = ", ".join([f"{START['bad']}::DOUBLE AS bad"] + [f"{START[n]}::DOUBLE AS {n}{j}" for n in ("hit", "miss") for j in range(r)])
    rounds = [f"s0 AS MATERIALIZED (SELECT {first})"]
    for i in range(ROUNDS):
        rate = lambda j, w, name: clamp(f"(sum(CASE WHEN v{j} = 1 THEN {w} ELSE 0 END) + {START[name] * WEIGHT}) / (sum(CASE WHEN v{j} < 2 THEN {w} ELSE 0 END) + {WEIGHT})", name) + f" AS {name}{j}"
        cols = [clamp("sum(w) / sum(n)", "bad") + " AS bad"] + [rate(j, "w", "hit") for j in range(r)] + [rate(j, "(n - w)", "miss") for j in range(r)]
        rounds.append(f"s{i + 1} AS MATERIALIZED (SELECT {', '.join(cols)} FROM (SELECT p.*, n * ({post('s')}) AS w FROM patterns p CROSS JOIN s{i} s))")
    return rf"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS g FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM base)
), again AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM again, range(0, 5) AS x(k) GROUP BY doc_id
), counts AS (
  SELECT b.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(t, '[^A-ZÀ-ÖØ-Þ]', '', 'g'))::BIGINT AS n_upper, length(regexp_replace(t, '[^!]', '', 'g'))::BIGINT AS n_marks,
    len(list_filter(words, lambda w: w IN ({listed(STOPS)})))::BIGINT AS n_stops, len(list_filter(words, lambda w: w IN ({listed(BARS)})))::BIGINT AS n_bars,
    len(list_filter(lines, lambda x: right(rtrim(x), 1) IN ('.', '!', '?')))::BIGINT AS n_ended, len(list_distinct(words))::BIGINT AS n_distinct,
    len(words)::BIGINT * coalesce(list_sum(list_transform(words, lambda w: length(w) * length(w))), 0)::BIGINT - length(array_to_string(words, ''))::BIGINT ** 2 AS n_spread
  FROM base b LEFT JOIN covered c USING (doc_id)
), voted AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, {votes} FROM counts
), patterns AS MATERIALIZED (
  SELECT {names}, count(*)::DOUBLE AS n FROM voted GROUP BY {names}
), {', '.join(rounds)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND ({post('s')}) <= 0.5 AS kept
FROM voted p CROSS JOIN s{ROUNDS} s
"""
