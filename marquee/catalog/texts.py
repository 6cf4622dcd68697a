"""Checks: tokens, cues, names, money, lexicon sentiment, TF-IDF."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee import bindings as b
from marquee.catalog.joining import _tokens_sql
from marquee.catalog.registry import query
from marquee.functions import fixed, text
from marquee.operators import lexicon, people, tfidf


@query("tokenize", sql=f"""
    SELECT doc_id, length({_tokens_sql('text')}) AS tokens, array_to_string(list_sort({_tokens_sql('text')}), ' ') AS joined
    FROM documents""")
def tokenize(spark, sf):
    tokens = b.table(spark, sf, "documents").select("doc_id", text.tokenize(F.col("text")).alias("t"))
    return tokens.select("doc_id", F.size("t").cast("bigint").alias("tokens"),
                         F.array_join(F.sort_array("t"), " ").alias("joined"))


@query("token_jaccard", sql=f"""
    WITH t AS (SELECT doc_id, {_tokens_sql('text')} AS w FROM documents)
    SELECT x.doc_id, CASE WHEN length(x.w) + length(y.w) = 0 THEN NULL ELSE round(length(list_intersect(x.w, y.w))
      / (length(x.w) + length(y.w) - length(list_intersect(x.w, y.w))), 6) END AS score
    FROM t x JOIN t y ON y.doc_id = x.doc_id + 1""")
def token_jaccard(spark, sf):
    sets = b.table(spark, sf, "documents").select("doc_id", text.tokenize(F.col("text")).alias("a"))
    following = sets.select((F.col("doc_id") - 1).alias("doc_id"), F.col("a").alias("c"))
    pair = sets.join(following, "doc_id")
    return pair.select("doc_id", F.round(text.jaccard(F.col("a"), F.col("c")), 6).alias("score"))


def _cues_sql(column, cues):
    return " + ".join(f"CAST(contains({column}, '{c}') AS INTEGER)" for c in cues)


@query("cue_hits", ctes="base", sql=f"""
    SELECT movie_id, {_cues_sql('o', fixed.LOW_QUALITY_CUES)} AS low, {_cues_sql('o', fixed.HIGH_QUALITY_CUES)} AS high,
      {_cues_sql('o', fixed.EVENT_CUES)} AS event
    FROM (SELECT movie_id, trim(lower(coalesce(overview, ''))) AS o FROM base)""")
def cue_hits(spark, sf):
    overview = text.clean_overview(F.col("overview"))
    return b.release_dates(spark, sf).select(
        "movie_id", text.cue_hits(overview, fixed.LOW_QUALITY_CUES).alias("low"),
        text.cue_hits(overview, fixed.HIGH_QUALITY_CUES).alias("high"),
        text.cue_hits(overview, fixed.EVENT_CUES).alias("event"))


_NAME = r"(?:[A-Z][a-z]+|[A-Z]\.)"
_FULL = rf"({_NAME}(?:\s{_NAME}){{1,3}})"
_ROLE = fixed.ROLE_LINE_PATTERN.replace("'", "''")
NAMES_CTE = rf"""
    lines AS (SELECT movie_id, pos, regexp_replace(trim(line), '^[-•*]\s+', '') AS line FROM (
      SELECT movie_id, unnest(string_split(overview, chr(10))) AS line,
        unnest(range(length(string_split(overview, chr(10))))) AS pos FROM base WHERE overview IS NOT NULL)),
    led AS (SELECT movie_id, pos, 0 AS part, regexp_extract(line, '^{_FULL}\s*[-–—]', 1) AS name FROM lines
      WHERE regexp_matches(line, '^{_FULL}\s*[-–—]')),
    listed AS (SELECT movie_id, pos, unnest(range(length(parts))) AS part, trim(unnest(parts)) AS name FROM (
      SELECT movie_id, pos, regexp_split_to_array(regexp_extract(line, '{_ROLE}', 1), '[,&]|\s+and\s+') AS parts
      FROM lines WHERE NOT regexp_matches(line, '^{_FULL}\s*[-–—]'))),
    found AS (SELECT * FROM led UNION ALL SELECT * FROM listed WHERE regexp_matches(name, '^{_FULL}$')),
    named AS (SELECT movie_id, name, CAST(row_number() OVER (PARTITION BY movie_id ORDER BY min(pos * 1000 + part)) - 1
      AS INTEGER) AS seq FROM found GROUP BY movie_id, name)"""
BEST_CTE = """best AS (SELECT name, arg_max(person_id, (popularity, -person_id)) AS person_id,
      max(popularity) AS popularity FROM people GROUP BY name)"""


@query("extract_names", ctes="base", sql=f"WITH {NAMES_CTE} SELECT movie_id, seq, name FROM named")
def extract_names(spark, sf):
    return people.names_in_text(b.release_dates(spark, sf), "movie_id", "overview")


@query("text_cast_stats", ctes="base people", sql=f"""
    WITH {NAMES_CTE}, {BEST_CTE}
    SELECT movie_id, round(avg(popularity), 6) AS avg_cast_popularity, max(popularity) AS max_cast_popularity,
      CAST(count(*) AS INTEGER) AS num_cast_members, round(avg(popularity) * count(*), 6) AS star_power_score,
      string_agg(name || ' (' || format('{{:.1f}}', popularity) || ')', ', ' ORDER BY seq) AS found_names
    FROM named JOIN best USING (name) GROUP BY movie_id""")
def text_cast_stats(spark, sf):
    titles, known = b.release_dates(spark, sf), b.people(spark, sf)
    stats = people.text_cast_stats(titles, known)
    # The label list of one text's own names.
    labels = people.found_names(titles, known).groupBy("movie_id").agg(
        F.array_sort(F.collect_list(F.struct("seq", "label"))).alias("l"))
    return stats.join(labels, "movie_id").select(
        "movie_id", F.round("avg_cast_popularity", 6).alias("avg_cast_popularity"), "max_cast_popularity",
        "num_cast_members", F.round("star_power_score", 6).alias("star_power_score"),
        F.array_join(F.transform("l", lambda x: x["label"]), ", ").alias("found_names"))


REPUTATION_CTE = f"""{NAMES_CTE}, {BEST_CTE},
    known AS (SELECT movie_id, CASE WHEN b.popularity > 0 THEN b.popularity END AS pop, r.roi FROM named n
      LEFT JOIN best b USING (name) LEFT JOIN roi r USING (name) WHERE seq < 12),
    rep AS (SELECT movie_id, count(pop) AS pops, coalesce(avg(pop), 0e0) AS ap, coalesce(max(pop), 0e0) AS mp,
      count(roi) AS rois, coalesce(avg(roi), 0e0) AS ar, count(*) AS names_checked FROM known GROUP BY 1
      HAVING count(pop) > 0 OR count(roi) > 0),
    reputation AS (SELECT movie_id, least(greatest(1e0
        + CASE WHEN pops > 0 AND (ap >= 25 OR mp >= 40) THEN 0.10e0 WHEN pops > 0 AND ap <= 8 AND mp <= 12 THEN -0.10e0
          ELSE 0e0 END
        + CASE WHEN rois > 0 AND ar >= 6 THEN 0.08e0 WHEN rois > 0 AND ar <= 1.2e0 THEN -0.08e0 ELSE 0e0 END,
        0.75e0), 1.25e0) AS factor, ap, mp, ar, names_checked FROM rep)"""


@query("reputation_factor", ctes="base people roi", sql=f"""
    WITH {REPUTATION_CTE} SELECT movie_id, factor, round(ap, 6) AS avg_popularity, mp AS max_popularity,
      round(ar, 6) AS avg_historical_roi, names_checked FROM reputation""")
def reputation_factor(spark, sf):
    found = people.reputation(b.release_dates(spark, sf), b.people(spark, sf), b.roi(spark, sf))
    return found.withColumns({c: F.round(c, 6) for c in ("avg_popularity", "avg_historical_roi")})


@query("extract_money", sql=r"""
    SELECT movie_id, mode, CASE WHEN k10 = 0 THEN CASE mode WHEN 'decimals' THEN '$2.798 billion' ELSE '$2' END
        WHEN k10 = 1 THEN NULL ELSE '$' || amount || ' million' END AS worldwide_box_office,
      CASE WHEN k11 = 0 THEN NULL WHEN k11 = 1 THEN '$' || amount || ',000'
        ELSE '$' || CAST(1 + movie_id % 300 AS VARCHAR) || ' million' END AS budget
    FROM (SELECT o_orderkey AS movie_id, o_orderkey % 10 AS k10, o_orderkey % 11 AS k11,
            CAST(1 + o_orderkey % 9 AS VARCHAR) || ',' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') AS amount
          FROM orders) CROSS JOIN (VALUES ('decimals'), ('whole')) m(mode)""")
def extract_money(spark, sf):
    articles = b.articles(spark, sf)
    out = [
        articles.select("movie_id", F.lit(mode).alias("mode"), text.extract_money(F.col("text"), flag).alias("m")).select(
            "movie_id", "mode", "m.worldwide_box_office", "m.budget")
        for mode, flag in (("decimals", True), ("whole", False))]
    return out[0].unionByName(out[1])


_MONEY_TEXT = """CASE o_orderkey % 8 WHEN 0 THEN '$' || CAST(o_orderkey AS STRING) || ' million'
    WHEN 1 THEN '$1.5 billion' WHEN 2 THEN '$1,234,567' WHEN 3 THEN '' WHEN 4 THEN NULL WHEN 5 THEN '$2 Billion'
    WHEN 6 THEN 'unknown' ELSE '$' || CAST(o_orderkey % 10 AS STRING) || ',000' END"""


@query("parse_money", sql="""
    SELECT o_orderkey AS movie_id, CASE o_orderkey % 8 WHEN 0 THEN CAST(o_orderkey AS DOUBLE) WHEN 1 THEN 1500e0
      WHEN 2 THEN 1234567e0 / 1000000 WHEN 5 THEN 2000e0 WHEN 7 THEN (o_orderkey % 10) * 1000 / 1000000 END AS millions
    FROM orders""")
def parse_money(spark, sf):
    return b.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("movie_id"), text.parse_money(F.expr(_MONEY_TEXT)).alias("millions"))


def _boost_sql(column):
    groups = {}
    for word, weight in fixed.BOOSTERS.items():
        groups.setdefault(weight, []).append(f"'{word}'")
    cases = " ".join(f"WHEN {column} IN ({', '.join(words)}) THEN {weight}e0" for weight, words in groups.items())
    return f"CASE {cases} ELSE 0e0 END"


_NEG = ", ".join("'" + w.replace("'", "''") + "'" for w in fixed.NEGATIONS)


def _pair_sql(k):
    pairs = ", ".join(f"'{p}'" for p in fixed.DAMPENING_PAIRS)
    return f"CASE WHEN concat_ws(' ', b{k + 1}, b{k}) IN ({pairs}) THEN -0.293e0 ELSE {_boost_sql(f'b{k}')} END"


SENTIMENT_CTE = f"""
    toks AS (SELECT movie_id, turn, unnest(w) AS token, unnest(range(length(w))) AS i FROM (
      SELECT movie_id, turn, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}'']+') AS w FROM spoken)),
    ctx AS (SELECT *, lag(token, 1) OVER p AS b1, lag(token, 2) OVER p AS b2, lag(token, 3) OVER p AS b3 FROM toks
      WINDOW p AS (PARTITION BY movie_id, turn ORDER BY i)),
    valued AS (SELECT movie_id, turn, (valence + sign(valence) * ({_pair_sql(1)} * 1.0e0 + {_pair_sql(2)} * 0.95e0
        + {_boost_sql('b3')} * 0.9e0)) * CASE WHEN b1 IN ({_NEG}) OR b2 IN ({_NEG}) OR b3 IN ({_NEG}) THEN -0.74e0
        ELSE 1e0 END AS v FROM ctx JOIN lexicon USING (token)),
    totals AS (SELECT movie_id, turn, sum(v) AS s FROM valued GROUP BY 1, 2)"""


@query("lexicon_sentiment", ctes="lexicon base", sql=f"""
    WITH spoken AS (SELECT conv_id AS movie_id, turn, text FROM conversations
        UNION ALL SELECT movie_id, -1, overview FROM base), {SENTIMENT_CTE}
    SELECT movie_id, turn, round(coalesce(s, 0e0) / sqrt(coalesce(s, 0e0) * coalesce(s, 0e0) + 15e0), 6) AS compound
    FROM spoken LEFT JOIN totals USING (movie_id, turn)""")
def lexicon_sentiment(spark, sf):
    overviews = b.release_dates(spark, sf).select("movie_id", F.lit(-1).cast("bigint").alias("turn"),
                                                  F.col("overview").alias("text"))
    spoken = b.comments(spark, sf).unionByName(overviews)
    scored = lexicon.comment_scores(spoken, b.lexicon(spark), ["movie_id", "turn"])
    return scored.withColumn("compound", F.round("compound", 6))


KEYWORDS_SQL = (
    r"""list_filter(list_transform(string_split(regexp_replace(regexp_replace(lower({t}), '[^a-z0-9\s]+', '|', 'g'),
      '\b(?:""" + "|".join(fixed.STOP_WORDS) + r""")\b', '|', 'g'), '|'),
      lambda r: trim(regexp_replace(r, '\s+', ' ', 'g'))), lambda r: length(r) > 2)""")


def _first_distinct(expression, limit=5):
    """First distinct entries of a list, in order."""
    return (f"list_filter({expression}, lambda x, i: list_position({expression}, x) = i)[1:{limit}]")


@query("keywords", ctes="base", sql=f"""
    SELECT doc_id, array_to_string({_first_distinct('ks')}, '; ') AS keywords
    FROM (SELECT doc_id, {KEYWORDS_SQL.format(t='text')} AS ks FROM documents)""")
def keywords(spark, sf):
    return b.table(spark, sf, "documents").select(
        "doc_id", F.array_join(text.key_phrases(F.col("text")), "; ").alias("keywords"))


OVERVIEW_CTE = """
    otoks AS (SELECT movie_id, unnest(regexp_extract_all(lower(overview), '[\\p{L}\\p{N}'']+')) AS token FROM base),
    omeans AS (SELECT movie_id, avg(polarity) AS p, avg(subjectivity) AS s FROM otoks JOIN lexicon USING (token)
      GROUP BY 1)"""


@query("overview_nlp", ctes="base lexicon", sql=rf"""
    WITH {OVERVIEW_CTE}
    SELECT movie_id, CASE WHEN ok THEN round(coalesce(p, 0e0), 6) END AS sentiment_score,
      CASE WHEN ok THEN round(coalesce(s, 0e0), 6) END AS subjectivity_score,
      CASE WHEN NOT ok THEN NULL WHEN coalesce(p, 0e0) > 0.1e0 THEN 'Positive' WHEN coalesce(p, 0e0) < -0.1e0 THEN 'Negative'
        ELSE 'Neutral' END AS sentiment_label,
      CASE WHEN ok THEN array_to_string({_first_distinct('ks')}, '; ') END AS keywords,
      CASE WHEN ok THEN CAST(length(regexp_extract_all(overview, '\S+')) AS INTEGER) END AS word_count
    FROM (SELECT base.movie_id, overview, coalesce(overview, '') <> '' AS ok, p, s,
            {KEYWORDS_SQL.format(t="coalesce(overview, '')")} AS ks
          FROM base LEFT JOIN omeans ON omeans.movie_id = base.movie_id)""")
def overview_nlp(spark, sf):
    out = lexicon.overview_stats(b.release_dates(spark, sf), b.lexicon(spark), "movie_id")
    return out.withColumns({
        "sentiment_score": F.round("sentiment_score", 6), "subjectivity_score": F.round("subjectivity_score", 6),
        "keywords": F.array_join("keywords", "; ")})


_ENGLISH = ", ".join(f"'{w}'" for w in fixed.ENGLISH_STOP_WORDS)


@query("tfidf_terms", sql=rf"""
    WITH terms AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}')) AS term FROM documents),
      tf AS (SELECT doc_id, term, count(*) AS tf FROM terms WHERE NOT list_contains([{_ENGLISH}], term) GROUP BY 1, 2),
      vocab AS (SELECT term, count(*) AS df FROM tf GROUP BY 1 ORDER BY sum(tf) DESC, term LIMIT 100),
      w AS (SELECT doc_id, tf.term, tf * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS w
            FROM tf JOIN vocab ON vocab.term = tf.term)
    SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS tfidf FROM w""")
def tfidf_terms(spark, sf):
    weights = tfidf.tfidf_terms(b.table(spark, sf, "documents"), "doc_id", "text")
    return weights.withColumn("tfidf", F.round("tfidf", 6))
