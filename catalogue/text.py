"""Text functions, emoji, normalised text, lists as text, keywords and themes."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import query, table
from catalogue.reviews import CLEANED_SQL, LABELLED_SQL, REVIEWS_SQL, cleaned, labelled, reviews
from revlens.functions import lists, text as fn
from revlens.functions.lemmas import KEPT, RULES, base_form
from revlens.functions.vocab import EMOJI_WORDS, LEMMAS, NO_THEME, STOP_WORDS, THEME_RULES
from revlens.operators import keywords as kw, normalise, themes
from revlens.operators.distributions import keyword_frequencies
from revlens.operators.sentiment import label_from_rating

RAW = f"WITH {REVIEWS_SQL} "
CLEANED = f"WITH {CLEANED_SQL} "
NON_WORD = r"[^\p{L}\p{N}_\s]"
TOKEN = r"[\p{L}\p{N}_]{2,}"


@query(
    "text_functions",
    RAW + rf"""SELECT review_id, md5(lower(content)) AS lowered, md5(regexp_replace(content, '{NON_WORD}', '', 'g')) AS no_punctuation,
      md5(trim(regexp_replace(content, '\s+', ' ', 'g'))) AS squeezed, md5(regexp_replace(content, '^\s+|\s+$', '', 'g')) AS stripped,
      md5(replace(content, 'the', 'THE')) AS replaced, contains(content, 'login') AS has_login, left(content, 512) AS head,
      CAST(len(regexp_extract_all(lower(content), '{TOKEN}')) AS INT) AS n_words FROM reviews WHERE content IS NOT NULL""",
)
def text_functions(spark, folder):
    rows = reviews(spark, folder).where("content is not null")
    return rows.select(
        "review_id",
        F.md5(F.lower("content")).alias("lowered"),
        F.md5(fn.strip_punctuation("content")).alias("no_punctuation"),
        F.md5(fn.squeeze("content")).alias("squeezed"),
        F.md5(fn.strip("content")).alias("stripped"),
        F.md5(F.replace("content", F.lit("the"), F.lit("THE"))).alias("replaced"),
        F.contains("content", F.lit("login")).alias("has_login"),
        fn.head_chars("content").alias("head"),
        F.size(fn.words("content")).alias("n_words"),
    )


@query(
    "math_functions",
    "SELECT event_id, round(ln(1 + value), 6) AS log_value, round(sqrt(value), 6) AS root, round(exp(-value / 100), 6) AS decay FROM events",
)
def math_functions(spark, folder):
    v = F.col("value")
    rounded = {"log_value": F.log(1 + v), "root": F.sqrt(v), "decay": F.exp(-v / 100)}
    return table(spark, folder, "events").select("event_id", *[F.round(e, 6).alias(n) for n, e in rounded.items()])


def _emoji_sql(text: str) -> str:
    for emoji, word in EMOJI_WORDS.items():
        text = f"replace({text}, '{emoji}', '{word}')"
    ranges = r"[\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}\x{2B00}-\x{2BFF}\x{FE0F}\x{200D}\x{20E3}\x{E0020}-\x{E007F}]"
    return rf"trim(regexp_replace(regexp_replace({text}, '{ranges}', '', 'g'), '\s+', ' ', 'g'))"


@query("emoji_to_words", RAW + f"SELECT review_id, {_emoji_sql('content')} AS content FROM reviews")
def emoji_to_words(spark, folder):
    return reviews(spark, folder).select("review_id", fn.replace_emoji("content").alias("content"))


STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)
BASES = ", ".join(f"('{form}', '{base}')" for form, base in LEMMAS.items())


def normal_ctes(source: str, row_id: str, text: str, otherwise: str = "p.w") -> str:
    """CTEs ending in `normal(id, cleaned_text)` for the rows of `source`."""
    return rf"""bases(form, base) AS (VALUES {BASES}),
    splits AS (SELECT {row_id} AS id, string_split_regex(regexp_replace(lower(coalesce({text}, '')), '{NON_WORD}', '', 'g'), '\s+') AS ws FROM {source}),
    pieces AS (SELECT id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM splits),
    joined AS (SELECT p.id, string_agg(coalesce(b.base, {otherwise}), ' ' ORDER BY p.i) AS t FROM pieces p LEFT JOIN bases b ON b.form = p.w
      WHERE p.w <> '' AND p.w NOT IN ({STOPS}) GROUP BY p.id),
    normal AS (SELECT s.id, coalesce(j.t, '') AS cleaned_text FROM splits s LEFT JOIN joined j ON j.id = s.id)"""


@query("normalised_text", RAW + f", {normal_ctes('reviews', 'review_id', 'content')} SELECT id AS review_id, cleaned_text FROM normal")
def normalised_text(spark, folder):
    return normalise.add_cleaned_text(reviews(spark, folder), "content").select("review_id", "cleaned_text")


@query("normalised_text_by_tables", RAW + f", {normal_ctes('reviews', 'review_id', 'content')} SELECT id AS review_id, cleaned_text FROM normal")
def normalised_text_by_tables(spark, folder):
    stops = spark.createDataFrame([(w,) for w in STOP_WORDS], "word string")
    bases = spark.createDataFrame(list(LEMMAS.items()), "word string, base string")
    cleaned_text = normalise.add_cleaned_text_from_tables(reviews(spark, folder), "review_id", "content", stops, bases)
    return cleaned_text.select("review_id", "cleaned_text")


BY_RULES = " ".join(
    [
        "CASE WHEN p.w IN (" + ", ".join(f"'{w}'" for w in sorted(KEPT)) + ") THEN p.w",
        *(f"WHEN regexp_matches(p.w, '{pattern}') THEN regexp_extract(p.w, '{pattern}', 1) || '{ending}'" for pattern, ending in RULES),
        "ELSE p.w END",
    ]
)


@query("normalised_text_by_rules", RAW + f", {normal_ctes('reviews', 'review_id', 'content', BY_RULES)} SELECT id AS review_id, cleaned_text FROM normal")
def normalised_text_by_rules(spark, folder):
    return reviews(spark, folder).select("review_id", fn.normalise("content", otherwise=base_form).alias("cleaned_text"))


THEMED = f"WITH {LABELLED_SQL} "


@query("themes_of_reviews", THEMED + "SELECT review_id, string_agg(theme, '|' ORDER BY theme) AS themes FROM themed GROUP BY review_id")
def themes_of_reviews(spark, folder):
    return labelled(spark, folder).select("review_id", F.array_join("themes", "|").alias("themes"))


@query(
    "list_text_round_trip",
    THEMED + "SELECT review_id, CAST(to_json(list(theme ORDER BY theme)) AS VARCHAR) AS as_json, string_agg(theme, '|' ORDER BY theme) AS parsed FROM themed GROUP BY review_id",
)
def list_text_round_trip(spark, folder):
    rows = labelled(spark, folder).select("review_id", lists.list_to_json("themes").alias("as_json"))
    return rows.withColumn("parsed", F.array_join(lists.parse_list("as_json"), "|"))


@query(
    "repaired_list_text",
    THEMED + """SELECT review_id, CASE WHEN bank = 'src1' THEN '[]' ELSE CAST(to_json(list(theme ORDER BY theme)) AS VARCHAR) END AS repaired,
      CASE WHEN bank = 'src1' THEN 'nolist' ELSE string_agg(theme, ', ' ORDER BY theme) END AS no_brackets FROM themed GROUP BY review_id, bank""",
)
def repaired_list_text(spark, folder):
    quoted = F.concat(F.lit("['"), F.array_join("themes", "', '"), F.lit("']"))
    raw = F.when(F.col("bank") == "src1", "nolist").otherwise(quoted)
    rows = labelled(spark, folder).select("review_id", raw.alias("raw"))
    plain = F.replace(lists.strip_brackets("raw"), F.lit("'"), F.lit(""))
    return rows.select("review_id", lists.repair_json_list("raw").alias("repaired"), plain.alias("no_brackets"))


@query(
    "split_theme_text",
    THEMED + "SELECT review_id, string_agg(lower(theme), '|' ORDER BY theme) AS from_commas, string_agg(lower(theme), '|' ORDER BY theme) AS from_json FROM themed GROUP BY review_id",
)
def split_theme_text(spark, folder):
    commas = F.array_join("themes", " , ,")
    return labelled(spark, folder).select(
        "review_id",
        F.array_join(lists.themes_of(commas), "|").alias("from_commas"),
        F.array_join(lists.themes_of(lists.list_to_json("themes")), "|").alias("from_json"),
    )


def term_ctes(source: str, row_id: str, text: str, max_terms: int = 1000) -> str:
    """CTEs ending in `weights(id, term, tf, df, weight)` for the rows of `source`."""
    return rf"""texts AS (SELECT {row_id} AS id, regexp_extract_all(lower({text}), '{TOKEN}') AS ws FROM {source} WHERE trim(regexp_replace({text}, '\s+', ' ', 'g')) <> ''),
    singles AS (SELECT id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM texts),
    pairs AS (SELECT id, w, lead(w) OVER (PARTITION BY id ORDER BY i) AS next FROM singles),
    terms AS (SELECT id, w AS term FROM singles UNION ALL SELECT id, w || ' ' || next FROM pairs WHERE next IS NOT NULL),
    vocab AS (SELECT term, count(*) AS corpus_count FROM terms GROUP BY term ORDER BY corpus_count DESC, term LIMIT {max_terms}),
    tfs AS (SELECT t.id, t.term, count(*) AS tf FROM terms t JOIN vocab v ON v.term = t.term GROUP BY ALL),
    dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term),
    raws AS (SELECT t.id, t.term, t.tf, d.df, t.tf * (ln(CAST(1 + (SELECT count(*) FROM texts) AS DOUBLE) / (1 + d.df)) + 1) AS w FROM tfs t JOIN dfs d ON d.term = t.term),
    weights AS (SELECT id, term, tf, df, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight FROM raws),
    tops AS (SELECT id, term, weight, CAST(row_number() OVER (PARTITION BY id ORDER BY round(weight, 12) DESC, term) AS INT) AS rank FROM weights)"""


TERMS = f"{CLEANED}, {term_ctes('cleaned', 'review_id', 'review')} "


@query("keyword_vocabulary", TERMS + "SELECT term, corpus_count FROM vocab")
def keyword_vocabulary(spark, folder):
    return kw.vocabulary(cleaned(spark, folder), "review_id", "review")


@query("keyword_weights", TERMS + "SELECT id AS review_id, term, tf, df, round(weight, 6) AS weight FROM weights")
def keyword_weights(spark, folder):
    return kw.term_weights(cleaned(spark, folder), "review_id", "review").withColumn("weight", F.round("weight", 6))


@query("top_keywords", TERMS + "SELECT id AS review_id, term, rank, round(weight, 6) AS weight FROM tops WHERE rank <= 5")
def top_keywords(spark, folder):
    best = kw.ranked_keywords(cleaned(spark, folder), "review_id", "review", 5)
    return best.select("review_id", "term", "rank", F.round("weight", 6).alias("weight"))


RAW_TERMS = f"{RAW}, {term_ctes('reviews', 'review_id', 'content')} "


@query(
    "keywords_on_reviews",
    RAW_TERMS + """SELECT r.review_id, coalesce(k.keywords, '') AS keywords FROM reviews r
    LEFT JOIN (SELECT id, string_agg(term, '|' ORDER BY rank) AS keywords FROM tops WHERE rank <= 5 GROUP BY id) k ON k.id = r.review_id""",
)
def keywords_on_reviews(spark, folder):
    rows = kw.add_keywords(reviews(spark, folder), "review_id", "content", 5)
    return rows.select("review_id", F.array_join("keywords", "|").alias("keywords"))


_WHENS = ", ".join(f"CASE WHEN contains(k.words, '{part}') THEN '{theme}' END" for part, theme in THEME_RULES.items())


@query(
    "themes_from_keywords",
    TERMS + f""", k AS (SELECT id, string_agg(term, chr(10)) AS words FROM tops WHERE rank <= 5 GROUP BY id),
      t AS (SELECT id, list_sort(list_distinct(list_filter([{_WHENS}], lambda x: x IS NOT NULL))) AS themes FROM k)
    SELECT c.review_id, CASE WHEN t.themes IS NULL OR len(t.themes) = 0 THEN '{NO_THEME}' ELSE array_to_string(t.themes, '|') END AS themes
    FROM cleaned c LEFT JOIN t ON t.id = c.review_id""",
)
def themes_from_keywords(spark, folder):
    rows = kw.add_keywords(cleaned(spark, folder), "review_id", "review", 5).transform(themes.add_themes)
    return rows.select("review_id", F.array_join("themes", "|").alias("themes"))


@query(
    "keyword_frequencies",
    TERMS + "SELECT term AS keyword, count(*) AS count FROM tops t JOIN cleaned c ON c.review_id = t.id WHERE rank <= 5 AND rating >= 4 GROUP BY term",
)
def keyword_frequency_table(spark, folder):
    rows = kw.add_keywords(cleaned(spark, folder), "review_id", "review", 5)
    return keyword_frequencies(rows.withColumn("sentiment_label", label_from_rating("rating")), "positive")


@query(
    "neighbouring_words",
    f"""WITH s AS (SELECT doc_id, regexp_extract_all(lower(text), '{TOKEN}') AS ws FROM documents),
      t AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM s),
      p AS (SELECT w || ' ' || lead(w) OVER (PARTITION BY doc_id ORDER BY i) AS pair FROM t)
    SELECT pair, count(*) AS count FROM p WHERE pair IS NOT NULL GROUP BY pair""",
)
def neighbouring_words(spark, folder):
    pairs = kw.word_pairs(table(spark, folder, "documents"), [], "text").where("next is not null")
    pairs = pairs.select(F.concat("word", F.lit(" "), "next").alias("pair"))
    return pairs.groupBy("pair").agg(F.count("*").alias("count"))
