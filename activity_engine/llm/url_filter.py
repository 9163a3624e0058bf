"""URL filters: list rules, else a character language-model ratio (operator 1).

A rule (host and path) decides the urls it fits; the longest one wins. Urls that a
rule decides also train two smoothed character models, one for allowed and one for
blocked urls: variable-order Markov models, where each order from 0 to ``ORDER``
is interpolated with the next lower one (Witten-Bell). Other urls are judged by
the difference of the two log-likelihoods per character, against a cutoff that
separates best the ruled urls kept out of training.

DataFrame functions only. Character grams are counted map-side, so the models are
tables of the distinct grams; the orders are joined by gram. Equal urls are scored
once. Only the cutoff, one number, reaches the driver.

Defined results: a null url, or one without ``://``, has empty host and path and
is judged by the models like any other; if rules decide no url of one kind for
training, the rest is allowed; with none of one kind for calibration the cutoff
is 0. Repeated rows each get their verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activity_engine.llm.common import materialize

#: The production list.
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
ORDER = 3
#: Scores are compared in steps of 1 / STEPS, up to LIMIT steps either way.
STEPS = 50
LIMIT = 500
#: First hex digits of a url's md5 that keep it out of training.
HOLDOUT = "0123"
START, END = "\x02", "\x03"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _cut(text: Column, *ends: str) -> Column:
    for end in ends:
        text = F.substring_index(text, end, 1)
    return text


def with_host_path(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """``pages`` with columns host and path."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    host = _cut(rest, "/", "?", "#")
    path = _cut(F.substr(rest, F.length(host) + 1), "?", "#")
    return pages.withColumns({"host": F.translate(host, _UPPER, _LOWER), "path": path})


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        own_host, slash, own_path = rule.partition("/")
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith(slash + own_path)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def grams(texts: DataFrame, order: int) -> DataFrame:
    """One row a character of each text and its end: the character after its ``order`` predecessors."""
    chars = F.split(F.concat(F.lit(START * order), F.col("text"), F.lit(END)), "")
    places = F.sequence(F.lit(1), F.length("text") + 1)
    each = F.transform(places, lambda i: F.array_join(F.slice(F.col("_chars"), i, order + 1), ""))
    return texts.withColumn("_chars", chars).withColumn("gram", F.explode(each)).drop("_chars")


def gram_log_odds(counted: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, odds): log P(last character | those before it), allowed minus blocked.

    ``counted``: distinct grams with their counts a (allowed) and b (blocked).
    """
    alphabet = counted.select(F.countDistinct(F.substr("gram", F.lit(order + 1)))).first()[0] + 1
    uniform = F.lit(1.0 / alphabet)
    lower = None
    for k in range(order + 1):
        level = counted.groupBy(F.substr("gram", F.lit(order + 1 - k)).alias("g")).agg(
            F.sum("a").alias("a"), F.sum("b").alias("b"))
        context = level.groupBy(F.left("g", F.lit(k)).alias("c")).agg(
            F.sum("a").alias("na"), F.sum("b").alias("nb"),
            F.count_if(F.col("a") > 0).alias("ta"), F.count_if(F.col("b") > 0).alias("tb"))
        level = level.withColumn("c", F.left("g", F.lit(k))).join(context, "c")
        if lower is None:
            level = level.withColumns({"la": uniform, "lb": uniform})
        else:
            level = level.withColumn("s", F.substr("g", F.lit(2))).join(lower, "s")
        smooth = lambda n, total, kinds, p: F.when(
            F.col(total) > 0, (F.col(n) + F.col(kinds) * F.col(p)) / (F.col(total) + F.col(kinds))).otherwise(F.col(p))
        lower = level.select(F.col("g").alias("s"), smooth("a", "na", "ta", "la").alias("la"),
                             smooth("b", "nb", "tb", "lb").alias("lb"))
    return lower.select(F.col("s").alias("gram"), (F.ln("la") - F.ln("lb")).alias("odds"))


def choose_cutoff(scored: DataFrame) -> int:
    """Step from which urls are allowed.

    The cut with the best sum of both kinds' hit rates (the least of equals), half
    way between the steps that it separates.
    """
    counts = (scored.groupBy("step").agg(F.count_if(F.col("verdict") == "allow").alias("a"),
                                         F.count_if(F.col("verdict") == "block").alias("b"))
              .orderBy("step").collect())  # at most 2 * LIMIT + 1 rows
    allowed, blocked = sum(r["a"] for r in counts), sum(r["b"] for r in counts)
    if not allowed or not blocked:
        return 0
    best, cutoff, above, below, last = -1.0, 0, allowed, 0, counts[0]["step"]
    for r in counts:
        gain = above / allowed + below / blocked
        if gain > best + 1e-9:
            best, cutoff = gain, (last + r["step"] + 1) // 2
        above, below, last = above - r["a"], below + r["b"], r["step"]
    return cutoff


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]] = RULES, url_col: str = "url",
               order: int = ORDER) -> DataFrame:
    """``pages`` with columns host, path, rule and verdict, in place of columns of these names."""
    named = with_host_path(pages, url_col).withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    texts = materialize(
        named.groupBy(F.concat("host", "path").alias("text")).agg(F.first("_rule.verdict").alias("verdict"))
        .withColumn("kept_out", F.substr(F.md5(F.col("text").cast("binary")), F.lit(1), F.lit(1)).isin(*HOLDOUT)), "urls")
    training = F.col("verdict").isNotNull() & ~F.col("kept_out")
    pieces = grams(texts, order)
    counted = materialize(pieces.groupBy("gram").agg(
        F.count_if(training & (F.col("verdict") == "allow")).alias("a"),
        F.count_if(training & (F.col("verdict") == "block")).alias("b")), "grams")
    sums = counted.agg(F.sum("a"), F.sum("b")).first()
    if not sums[0] or not sums[1]:
        judged = named.withColumn("_model", F.lit("allow"))
    else:
        odds = materialize(gram_log_odds(counted, order), "odds")
        step = F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(F.avg("odds") * STEPS))).cast("int")
        scored = (grams(texts.filter(~training | F.col("verdict").isNull()), order).join(odds, "gram")
                  .groupBy("text").agg(F.first("verdict").alias("verdict"), step.alias("step")))
        scored = materialize(scored, "scored")
        cutoff = choose_cutoff(scored.filter("verdict is not null"))
        model = F.when(F.col("step") >= cutoff, "allow").otherwise("block")
        rest = scored.filter("verdict is null").select(F.col("text").alias("_text"), model.alias("_model"))
        judged = named.join(rest, F.concat("host", "path") == F.col("_text"), "left").drop("_text")
    return (judged.withColumns({"rule": F.col("_rule.rule"), "verdict": F.coalesce("_rule.verdict", "_model")})
            .drop("_rule", "_model"))


def url_digest(pages: DataFrame) -> DataFrame:
    """The columns of query ``op1_url_filter``."""
    return judge_urls(pages.select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def url_sql(order: int = ORDER) -> str:
    """DuckDB SQL of ``url_digest``."""
    fits = " ".join(
        f"WHEN (host = '{r.partition('/')[0]}' OR ends_with(host, '.{r.partition('/')[0]}')) "
        f"AND starts_with(path, '/{r.partition('/')[2]}') THEN '{r}'"
        for r, _ in sorted(RULES, key=lambda r: (-len(r[0]), r[0])))
    verdicts = " ".join(f"WHEN '{r}' THEN '{v}'" for r, v in RULES)
    held = ", ".join(f"'{c}'" for c in HOLDOUT)
    ctes = [
        "cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3)"
        " ELSE '' END AS rest FROM pages)",
        "host AS (SELECT page_id, rest, split_part(split_part(split_part(rest, '/', 1), '?', 1), '#', 1) AS raw FROM cut)",
        f"named AS (SELECT page_id, translate(raw, '{_UPPER}', '{_LOWER}') AS host,"
        " split_part(split_part(substr(rest, length(raw) + 1), '?', 1), '#', 1) AS path FROM host)",
        f"ruled AS (SELECT *, host || path AS text, CASE {fits} END AS rule FROM named)",
        f"texts AS (SELECT text, any_value(CASE rule {verdicts} END) AS verdict,"
        f" substr(md5(text), 1, 1) IN ({held}) AS kept_out FROM ruled GROUP BY text)",
        f"padded AS (SELECT *, repeat(chr(2), {order}) || text || chr(3) AS s FROM texts)",
        f"pieces AS (SELECT text, verdict, kept_out, substr(s, i, {order + 1}) AS gram FROM padded,"
        f" unnest(range(1, length(text) + 2)) AS u(i))",
        "counted AS (SELECT gram, count(*) FILTER (WHERE verdict = 'allow' AND NOT kept_out) AS a,"
        " count(*) FILTER (WHERE verdict = 'block' AND NOT kept_out) AS b FROM pieces GROUP BY gram)",
        f"alphabet AS (SELECT 1.0::DOUBLE / (count(DISTINCT substr(gram, {order + 1})) + 1) AS u FROM counted)",
    ]
    for k in range(order + 1):
        ctes.append(f"l{k} AS (SELECT substr(gram, {order + 1 - k}) AS g, left(substr(gram, {order + 1 - k}), {k}) AS c,"
                    " sum(a) AS a, sum(b) AS b FROM counted GROUP BY 1, 2)")
        ctes.append(f"x{k} AS (SELECT c, sum(a) AS na, sum(b) AS nb, count(*) FILTER (WHERE a > 0) AS ta,"
                    f" count(*) FILTER (WHERE b > 0) AS tb FROM l{k} GROUP BY c)")
        lower = "CROSS JOIN (SELECT u AS la, u AS lb FROM alphabet) p" if k == 0 else f"JOIN p{k - 1} p ON p.s = substr(g, 2)"
        smooth = lambda n, p: (f"CASE WHEN n{n} > 0 THEN ({n} + t{n} * p.{p})::DOUBLE / (n{n} + t{n}) ELSE p.{p} END")
        ctes.append(f"p{k} AS (SELECT g AS s, {smooth('a', 'la')} AS la, {smooth('b', 'lb')} AS lb"
                    f" FROM l{k} JOIN x{k} USING (c) {lower})")
    ctes += [
        "scored AS (SELECT text, any_value(verdict) AS verdict,"
        f" greatest(-{LIMIT}, least({LIMIT}, floor(avg(ln(la) - ln(lb)) * {STEPS})))::INTEGER AS step"
        f" FROM pieces JOIN p{order} ON s = gram WHERE kept_out OR verdict IS NULL GROUP BY text)",
        "steps AS (SELECT step, count(*) FILTER (WHERE verdict = 'allow') AS a,"
        " count(*) FILTER (WHERE verdict = 'block') AS b FROM scored WHERE verdict IS NOT NULL GROUP BY step)",
        "gains AS (SELECT step, (SELECT sum(a) FROM steps) AS na, (SELECT sum(b) FROM steps) AS nb,"
        " coalesce(lag(step) OVER (ORDER BY step), step) AS last, sum(a) OVER (ORDER BY step DESC) AS above, coalesce(sum(b) OVER (ORDER BY step"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM steps)",
        "cutoff AS (SELECT coalesce((SELECT floor((last + step + 1) / 2.0) FROM gains WHERE na > 0 AND nb > 0"
        " ORDER BY round(above / na + below / nb, 8) DESC, step LIMIT 1), 0) AS c),",
    ]
    return ("WITH " + ",\n".join(ctes).rstrip(",") + "\n"
            f"SELECT page_id, host, path, rule, CASE WHEN rule IS NOT NULL THEN CASE rule {verdicts} END"
            " WHEN (SELECT sum(a) FROM counted) > 0 AND (SELECT sum(b) FROM counted) > 0"
            " THEN CASE WHEN step >= (SELECT c FROM cutoff) THEN 'allow' ELSE 'block' END ELSE 'allow' END AS verdict\n"
            "FROM ruled LEFT JOIN scored USING (text)")
