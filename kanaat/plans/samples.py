"""Categories, quota samples, splits, folds and indicator columns."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from kanaat.functions import keys, labels
from kanaat.functions.fixed_values import CATEGORIES, CLASS_CAP, PROMPT
from kanaat.functions.text import safe_name
from kanaat.operators import categories, sampling, tables
from kanaat.plans.inputs import LABEL_COLUMNS, comments, labelled
from kanaat.plans.registry import LABELS, query, sql_clean
from kanaat.sources.tables import spread, table


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


DIMENSION = "dimension(category, description) AS (VALUES " + ", ".join(
    f"({_quoted(name)}, {_quoted(text)})" for name, text in CATEGORIES
) + ")"

# A custom dimension in the languages of the given texts.
NATURE = [
    ("articles", "Short words.\nAnahtar Kelimeler: the, des, und, los"),
    ("endings", "Word endings.\nAnahtar Kelimeler: tion, ment, ung, ción"),
    ("plain", "No keywords."),
]
NATURE_SQL = """judged AS (SELECT doc_id AS comment_id, category,
  CASE category WHEN 'articles' THEN regexp_matches(cleaned, 'the|des|und|los')
    WHEN 'endings' THEN regexp_matches(cleaned, 'tion|ment|ung|ción') ELSE false END::INTEGER AS label
FROM cleaned, (VALUES ('articles'), ('endings'), ('plain')) c(category))"""


@query(
    "comments_by_category",
    f"""WITH cleaned AS (SELECT doc_id, {sql_clean('text')} AS cleaned FROM documents), {NATURE_SQL}
SELECT comment_id, category, label FROM judged""",
)
def comments_by_category(spark, folder):
    return categories.keyword_hits(spread(comments(spark, folder)), pairs=NATURE).select(
        "comment_id", "category", "label"
    )


@query(
    "category_product",
    f"""WITH {DIMENSION} SELECT category, lang, count(*)::BIGINT AS comments, count(DISTINCT doc_id)::BIGINT AS ids
FROM documents, dimension GROUP BY ALL""",
)
def category_product(spark, folder):
    pairs = categories.per_category(comments(spark, folder).select("comment_id", "lang"))
    return pairs.groupBy("category", "lang").agg(
        F.count(F.lit(1)).alias("comments"), F.countDistinct("comment_id").alias("ids")
    )


def _topic(column):
    """A category of the fixed dimension for each language of the given texts."""
    named = {"en": "Ürün", "de": "Teslimat", "fr": "Boykot", "es": "İade / İptal / Değişim"}
    return F.create_map(*[F.lit(x) for pair in named.items() for x in pair])[column]


TOPIC_SQL = """CASE lang WHEN 'en' THEN 'Ürün' WHEN 'de' THEN 'Teslimat' WHEN 'fr' THEN 'Boykot'
  WHEN 'es' THEN 'İade / İptal / Değişim' END"""


@query(
    "description_lookup",
    f"""WITH {DIMENSION}, topics AS (SELECT doc_id AS comment_id, {TOPIC_SQL} AS category FROM documents)
SELECT comment_id, category, description,
  len(string_split(string_split(description, 'Anahtar Kelimeler:')[2], ','))::INTEGER AS keywords
FROM topics JOIN dimension USING (category)""",
)
def description_lookup(spark, folder):
    topics = comments(spark, folder).select("comment_id", _topic(F.col("lang")).alias("category"))
    return categories.described(topics).select(
        "comment_id", "category", "description", F.size("keywords").alias("keywords")
    )


def _sql_prompt() -> str:
    parts = [f"({{{p[1:-1]}}})" if p.startswith("{") else _quoted(p) for p in re.split(r"(\{\w+\})", PROMPT) if p]
    return " || ".join(parts).format(comment="text", category="category", description="description")


@query(
    "rendered_prompts",
    f"""WITH {DIMENSION}, topics AS (SELECT doc_id AS comment_id, text, {TOPIC_SQL} AS category FROM documents)
SELECT comment_id, category, {_sql_prompt()} AS prompt FROM topics JOIN dimension USING (category)""",
)
def rendered_prompts(spark, folder):
    topics = comments(spark, folder).select("comment_id", "text", _topic(F.col("lang")).alias("category"))
    return categories.described(topics).select(
        "comment_id",
        "category",
        labels.render_prompt(F.col("text"), F.col("category"), F.col("description")).alias("prompt"),
    )


@query(
    "parsed_answers",
    """SELECT conv_id, turn, CASE WHEN contains(lower(replace(text, 'the', 'evet')), '1')
  OR contains(lower(replace(text, 'the', 'evet')), 'evet') THEN 1 ELSE 0 END AS label FROM conversations""",
)
def parsed_answers(spark, folder):
    answer = F.replace("text", F.lit("the"), F.lit("evet"))
    return table(spark, folder, "conversations").select("conv_id", "turn", labels.parse_answer(answer).alias("label"))


@query(
    "safe_file_names",
    r"""SELECT page_id, regexp_replace(url, '[^\p{L}\p{N}]', '_', 'g') || '_' || lower(title) AS name
FROM (SELECT page_id, url, regexp_replace(regexp_extract(html, '<title>([^<]*)', 1), '[^\p{L}\p{N}]', '_', 'g') AS title
FROM pages)""",
)
def safe_file_names(spark, folder):
    title = safe_name(F.regexp_extract("html", "<title>([^<]*)", 1))
    return table(spark, folder, "pages").select(
        "page_id", F.concat(safe_name(F.col("url")), F.lit("_"), F.lower(title)).alias("name")
    )


@query(
    "source_indicators",
    """SELECT doc_id AS comment_id, lang, (lang = 'en')::INTEGER AS en, (lang = 'de')::INTEGER AS de,
  (lang = 'fr')::INTEGER AS fr, (lang = 'es')::INTEGER AS es FROM documents""",
)
def source_indicators(spark, folder):
    rows = comments(spark, folder).select("comment_id", "lang")
    return tables.source_indicators(rows, "lang", ["en", "de", "fr", "es"])


@query(
    "prediction_indicators",
    f"""WITH {LABELS} SELECT comment_id, max(CASE WHEN category = 'quality' THEN label ELSE 0 END) AS quality,
  max(CASE WHEN category = 'toxic' THEN label ELSE 0 END) AS toxic FROM labelled GROUP BY comment_id""",
)
def prediction_indicators(spark, folder):
    return tables.prediction_indicators(labelled(spark, folder), "comment_id", LABEL_COLUMNS, value="label")


TARGETS = (40, 60)


@query(
    "label_tally",
    f"""WITH {LABELS} SELECT category, sum(label)::BIGINT AS positives, sum(1 - label)::BIGINT AS negatives,
  CASE WHEN sum(label) >= {TARGETS[0]} AND sum(1 - label) >= {TARGETS[1]} THEN 1 ELSE 0 END AS complete
FROM labelled GROUP BY category""",
)
def label_tally(spark, folder):
    return tables.label_tally(labelled(spark, folder), *TARGETS)


KEYED = f"""{LABELS}, keyed AS (SELECT *, md5('42|' || comment_id::VARCHAR) AS k FROM labelled),
ranked AS (SELECT category, comment_id, label, k, row_number() OVER (PARTITION BY category, label ORDER BY k, comment_id) AS rank,
  count(*) OVER (PARTITION BY category, label) AS total FROM keyed)"""


@query(
    "quota_sample",
    f"""WITH {KEYED} SELECT category, comment_id, label, rank FROM ranked
WHERE rank <= CASE label WHEN 1 THEN {TARGETS[0]} ELSE {TARGETS[1]} END""",
)
def quota_sample(spark, folder):
    return sampling.quota_sample(labelled(spark, folder), *TARGETS).select("category", "comment_id", "label", "rank")


@query(
    "quota_sample_in_order",
    f"""WITH {LABELS} SELECT category, comment_id, label FROM labelled
QUALIFY row_number() OVER (PARTITION BY category, label ORDER BY comment_id)
  <= CASE label WHEN 1 THEN {TARGETS[0]} ELSE {TARGETS[1]} END""",
)
def quota_sample_in_order(spark, folder):
    return sampling.quota_sample(labelled(spark, folder), *TARGETS, mode="positive_only").select(
        "category", "comment_id", "label"
    )


@query(
    "examined_rows",
    f"""WITH {KEYED}, walk AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY k, comment_id) AS step FROM ranked),
stops AS (SELECT category, max(step) AS last_step, count(*) FILTER (label = 1)::BIGINT AS found_positive,
  count(*) FILTER (label = 0)::BIGINT AS found_negative FROM walk
  WHERE rank <= CASE label WHEN 1 THEN {TARGETS[0]} ELSE {TARGETS[1]} END GROUP BY category)
SELECT s.category, found_positive, found_negative,
  CASE WHEN found_positive >= {TARGETS[0]} AND found_negative >= {TARGETS[1]} THEN last_step ELSE n END::BIGINT AS examined,
  CASE WHEN found_positive >= {TARGETS[0]} AND found_negative >= {TARGETS[1]} THEN 1 ELSE 0 END AS complete
FROM stops s JOIN (SELECT category, count(*) AS n FROM walk GROUP BY category) USING (category)""",
)
def examined_rows(spark, folder):
    return sampling.examined_rows(labelled(spark, folder), *TARGETS)


@query(
    "running_tally",
    f"""WITH {KEYED} SELECT category, comment_id, row_number() OVER w AS step, (sum(label) OVER w)::BIGINT AS positives,
  (sum(1 - label) OVER w)::BIGINT AS negatives, round((sum(label) OVER w) * 100.0 / {TARGETS[0]}, 6) AS percent
FROM keyed WINDOW w AS (PARTITION BY category ORDER BY k, comment_id ROWS UNBOUNDED PRECEDING)""",
)
def running_tally(spark, folder):
    percent = labels.percent_of(F.col("positives"), F.lit(TARGETS[0]))
    return sampling.running_tally(labelled(spark, folder)).select(
        "category", "comment_id", "step", "positives", "negatives", F.round(percent, 6).alias("percent")
    )


@query(
    "capped_class_sample",
    f"""WITH {KEYED} SELECT category, comment_id, label, (rank <= 50)::INTEGER AS in_sample FROM ranked""",
)
def capped_class_sample(spark, folder):
    return sampling.capped_class_sample(labelled(spark, folder), cap=50).select(
        "category", "comment_id", "label", F.col("in_sample").cast("int").alias("in_sample")
    )


@query(
    "training_and_scoring_sizes",
    f"""WITH {KEYED} SELECT category, label, count(*) FILTER (rank <= {CLASS_CAP})::BIGINT AS to_train,
  count(*) FILTER (rank > {CLASS_CAP})::BIGINT AS to_score FROM ranked GROUP BY ALL""",
)
def training_and_scoring_sizes(spark, folder):
    return sampling.capped_class_sample(labelled(spark, folder)).groupBy("category", "label").agg(
        F.count_if("in_sample").alias("to_train"), F.count_if(~F.col("in_sample")).alias("to_score")
    )


@query(
    "remaining_after_sample",
    f"""WITH {KEYED} SELECT category, comment_id FROM ranked WHERE rank > 50""",
)
def remaining_after_sample(spark, folder):
    rows = labelled(spark, folder).select("category", "comment_id", "label")
    taken = sampling.quota_sample(rows, 50, 50)
    return sampling.remaining(rows, taken, ["category", "comment_id"]).select("category", "comment_id")


@query(
    "stratified_split",
    f"""WITH {KEYED} SELECT category, comment_id, label, (rank <= floor(total * 0.3 + 0.5))::INTEGER AS is_test FROM ranked""",
)
def stratified_split(spark, folder):
    return sampling.stratified_split(labelled(spark, folder), 0.3).select(
        "category", "comment_id", "label", F.col("is_test").cast("int").alias("is_test")
    )


@query(
    "split_sizes",
    f"""WITH {KEYED}, parted AS (SELECT category, rank <= floor(total * 0.2 + 0.5) AS is_test FROM ranked)
SELECT category, count(*) FILTER (NOT is_test)::BIGINT AS train, count(*) FILTER (is_test)::BIGINT AS test,
  round(count(*) FILTER (is_test) * 100.0 / count(*), 6) AS test_share FROM parted GROUP BY category""",
)
def split_sizes(spark, folder):
    return sampling.stratified_split(labelled(spark, folder), 0.2).groupBy("category").agg(
        F.count_if(~F.col("is_test")).alias("train"),
        F.count_if("is_test").alias("test"),
        F.round(F.count_if("is_test") * 100.0 / F.count(F.lit(1)), 6).alias("test_share"),
    )


@query(
    "stratified_folds",
    f"""WITH {KEYED} SELECT category, comment_id, label, ((rank - 1) % 10)::INTEGER AS fold FROM ranked""",
)
def stratified_folds(spark, folder):
    return sampling.stratified_folds(labelled(spark, folder), 10).select("category", "comment_id", "label", "fold")


@query(
    "seeded_shuffle",
    """SELECT doc_id AS comment_id, lang, row_number() OVER (ORDER BY md5('42|' || doc_id::VARCHAR), doc_id) AS position
FROM documents""",
)
def seeded_shuffle(spark, folder):
    return sampling.shuffled_positions(comments(spark, folder).select("comment_id", "lang"))


@query(
    "sample_and_rest_union",
    f"""WITH {KEYED} SELECT category, CASE WHEN rank <= 50 THEN 'train' ELSE 'score' END AS part,
  md5(category || '‖' || comment_id::VARCHAR) AS row_key FROM ranked""",
)
def sample_and_rest_union(spark, folder):
    parted = sampling.capped_class_sample(labelled(spark, folder), cap=50)
    return parted.select(
        "category",
        F.when(F.col("in_sample"), "train").otherwise("score").alias("part"),
        keys.row_id(F.col("category"), F.col("comment_id").cast("string")).alias("row_key"),
    )
