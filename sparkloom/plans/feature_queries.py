"""Registered feature queries: text, image and vector features (with oracles)."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkloom.operators import combine, numbering
from sparkloom.plans.registry import register, table

# ---------------------------------------------------------------- vectors
# Fixed fixture rule: in `embeddings`, even vec_id rows are the text side and
# odd ones the image side; both halves of a pair share id = vec_id div 2.

_DUCK_SIDES = """t AS (SELECT vec_id // 2 AS pair_id, embedding AS v FROM embeddings WHERE vec_id % 2 = 0),
i AS (SELECT vec_id // 2 AS pair_id, embedding AS v FROM embeddings WHERE vec_id % 2 = 1)"""


def _sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    e = table(spark, sf, "embeddings")
    side = F.col("vec_id") % 2
    t = e.filter(side == 0).select((F.col("vec_id") / 2).cast("bigint").alias("pair_id"), F.col("embedding").alias("vector"))
    i = e.filter(side == 1).select((F.col("vec_id") / 2).cast("bigint").alias("pair_id"), F.col("embedding").alias("vector"))
    return t, i


@register(
    "pair_features",
    f"""WITH {_DUCK_SIDES}
SELECT pair_id, len(t.v) AS text_dim, len(i.v) AS image_dim FROM t JOIN i USING (pair_id)""",
)
def q_pair_features(spark: SparkSession, sf: str) -> DataFrame:
    t, i = _sides(spark, sf)
    p = combine.pair_features(t, i, "pair_id")
    return p.select("pair_id", F.size("text_vec").alias("text_dim"), F.size("image_vec").alias("image_dim"))


@register(
    "pair_by_position",
    """WITH t AS (SELECT vec_id, row_number() OVER (ORDER BY label, vec_id) - 1 AS position FROM embeddings WHERE vec_id % 2 = 0),
i AS (SELECT vec_id AS image_id, row_number() OVER (ORDER BY label DESC, vec_id) - 1 AS position FROM embeddings WHERE vec_id % 2 = 1)
SELECT position, vec_id AS text_id, image_id FROM t JOIN i USING (position)""",
)
def q_pair_by_position(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings").select("vec_id", "label")
    t = e.where("vec_id % 2 = 0").select(F.col("vec_id").alias("text_id"), F.col("label").alias("text_label"))
    i = e.where("vec_id % 2 = 1").select(F.col("vec_id").alias("image_id"), F.col("label").alias("image_label"))
    p = numbering.pair_by_position(t, i, ["text_label", "text_id"], [F.desc("image_label"), "image_id"])
    return p.select("position", "text_id", "image_id")


@register(
    "pairing_report",
    f"""WITH {_DUCK_SIDES}, tk AS (SELECT pair_id, count(*) AS nt FROM t GROUP BY pair_id),
ik AS (SELECT pair_id, count(*) AS ni FROM i GROUP BY pair_id),
j AS (SELECT tk.nt, ik.ni FROM tk FULL OUTER JOIN ik ON tk.pair_id = ik.pair_id)
SELECT count_if(ni IS NULL) AS text_only, count_if(nt IS NULL) AS image_only,
       count_if(coalesce(nt, 0) > 1 OR coalesce(ni, 0) > 1) AS duplicated FROM j""",
)
def q_pairing_report(spark: SparkSession, sf: str) -> DataFrame:
    t, i = _sides(spark, sf)
    return combine.pairing_report(t, i, "pair_id")


@register(
    "combine_concat",
    f"""WITH {_DUCK_SIDES}, c AS (SELECT pair_id, list_concat(t.v::DOUBLE[], i.v::DOUBLE[]) AS v FROM t JOIN i USING (pair_id))
SELECT pair_id, generate_subscripts(v, 1) - 1 AS dim, round(unnest(v), 6) AS value FROM c""",
)
def q_combine_concat(spark: SparkSession, sf: str) -> DataFrame:
    t, i = _sides(spark, sf)
    return combine.long_form(combine.combine_concat(combine.pair_features(t, i, "pair_id")), "pair_id", "combined", 6)


@register(
    "combine_weighted",
    f"""WITH {_DUCK_SIDES},
p AS (SELECT pair_id, t.v::DOUBLE[] AS tv, i.v::DOUBLE[] AS iv FROM t JOIN i USING (pair_id)),
n AS (SELECT pair_id, tv, iv, sqrt(list_sum(list_transform(tv, lambda x: x * x))) AS nt,
             sqrt(list_sum(list_transform(iv, lambda x: x * x))) AS ni FROM p),
l AS (SELECT pair_id, nt, ni, unnest(tv) AS a, unnest(iv) AS b, generate_subscripts(tv, 1) - 1 AS dim FROM n)
SELECT pair_id, dim, round(0.7 * CASE WHEN nt > 0 THEN a / nt ELSE 0 END + 0.3 * CASE WHEN ni > 0 THEN b / ni ELSE 0 END, 6) AS value
FROM l""",
)
def q_combine_weighted(spark: SparkSession, sf: str) -> DataFrame:
    t, i = _sides(spark, sf)
    w = combine.combine_weighted(combine.pair_features(t, i, "pair_id"), 0.7, 0.3)
    return combine.long_form(w, "pair_id", "combined", 6)


_DUCK_ATTENTION = f"""WITH {_DUCK_SIDES},
s AS (SELECT t.pair_id AS tid, i.pair_id AS iid, list_dot_product(t.v::DOUBLE[], i.v::DOUBLE[]) AS sc FROM t, i),
p AS (SELECT tid, iid, exp(sc - max(sc) OVER (PARTITION BY tid)) AS e FROM s),
z AS (SELECT tid, iid, e / sum(e) OVER (PARTITION BY tid) AS w FROM p),
ie AS (SELECT pair_id AS iid, generate_subscripts(v, 1) - 1 AS dim, unnest(v)::DOUBLE AS x FROM i)
SELECT tid AS pair_id, dim, round(sum(w * x), 5) + 0.0 AS value FROM z JOIN ie USING (iid) GROUP BY tid, dim"""


@register("cross_attention", _DUCK_ATTENTION)
def q_cross_attention(spark: SparkSession, sf: str) -> DataFrame:
    t, i = _sides(spark, sf)
    out = combine.cross_attention(t, i, "pair_id", "pair_id")
    return combine.long_form(out, "pair_id", "combined", 5)


@register("cross_attention_blocked", _DUCK_ATTENTION)
def q_cross_attention_blocked(spark: SparkSession, sf: str) -> DataFrame:
    # small blocks force the multi-block path and its exact log-sum-exp merge
    t, i = _sides(spark, sf)
    out = combine.cross_attention(t, i, "pair_id", "pair_id", block_rows=64)
    return combine.long_form(out, "pair_id", "combined", 5)


@register(
    "feature_summary_vectors",
    f"""WITH {_DUCK_SIDES}, c AS (SELECT t.pair_id FROM t JOIN i USING (pair_id))
SELECT 'text' AS side, count(*) AS n_rows, max(len(v)) AS dim, 'CONCAT' AS method FROM t
UNION ALL SELECT 'image', count(*), max(len(v)), 'CONCAT' FROM i
UNION ALL SELECT 'combined', (SELECT count(*) FROM c), (SELECT max(len(v)) FROM t) + (SELECT max(len(v)) FROM i), 'CONCAT'""",
)
def q_feature_summary_vectors(spark: SparkSession, sf: str) -> DataFrame:
    t, i = _sides(spark, sf)
    c = combine.combine_concat(combine.pair_features(t, i, "pair_id"))
    return combine.vector_summary(t, i, c, "CONCAT")


# ---------------------------------------------------------------- text
from sparkloom.functions import inference, prompts  # noqa: E402
from sparkloom.functions.text import entities, semantic, sentiment, tagger, topics, vectors  # noqa: E402
from sparkloom.functions.text.entities import ENTITY_RULES  # noqa: E402

_DUCK_TOKENS = r"unnest(regexp_extract_all(lower(coalesce(text, '')), '\p{L}+'))"


@register(
    "text_topic_preprocess",
    f"""SELECT doc_id, term, count(*) AS count FROM (SELECT doc_id, {_DUCK_TOKENS} AS term FROM documents)
WHERE length(term) BETWEEN 2 AND 15 GROUP BY doc_id, term""",
)
def q_text_topic_preprocess(spark: SparkSession, sf: str) -> DataFrame:
    return topics.bag_of_words(table(spark, sf, "documents"), "doc_id", "text")


@register(
    "text_vectors_hashing",
    f"""WITH t AS (SELECT doc_id, {_DUCK_TOKENS} AS term FROM documents),
b AS (SELECT doc_id, ('0x' || substr(md5(term), 1, 8))::BIGINT % 256 AS bucket, count(*)::DOUBLE AS tf FROM t GROUP BY 1, 2),
n AS (SELECT count(*) AS n FROM documents),
f AS (SELECT bucket, count(*) AS df FROM b GROUP BY 1),
w AS (SELECT doc_id, bucket, tf * (ln((1 + n) / (1 + df)) + 1) AS w FROM b JOIN f USING (bucket), n),
z AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY 1)
SELECT doc_id, CAST(bucket AS INTEGER) AS bucket, round(w / norm, 6) AS value FROM w JOIN z USING (doc_id)""",
)
def q_text_vectors_hashing(spark: SparkSession, sf: str) -> DataFrame:
    out = vectors.hashed_tfidf(table(spark, sf, "documents"), "doc_id", "text", 256)
    return out.withColumn("value", F.round("value", 6))


@register("text_vectors_learnt", None)
def q_text_vectors_learnt(spark: SparkSession, sf: str) -> DataFrame:
    out = semantic.semantic_vectors(table(spark, sf, "documents"), "doc_id", "text", k=32)
    return out.select("doc_id", F.posexplode("vector").alias("dim", "value")).withColumn("value", F.round("value", 6))


# Test lexicon over invented tokens that occur in `documents`
# (token, polarity, subjectivity), and the negator tokens.
SENTIMENT_LEXICON = [
    ("hehely", 0.8, 0.9),
    ("orantion", 0.5, 0.6),
    ("ononst", 0.3, 0.4),
    ("thatin", 0.6, 0.7),
    ("rewh", -0.7, 0.8),
    ("orre", -0.4, 0.5),
    ("inoran", -0.9, 1.0),
    ("ble", -0.2, 0.3),
]
SENTIMENT_NEGATORS = ["th", "nd"]
# Test lexicon over function words of the four languages, so that the mean is far from 0.
TONE_LEXICON = [(t, 0.9, 0.5) for t in ("the", "of", "to", "and", "der", "die", "und", "de", "la", "que", "le", "et")]


def _lexicon(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    lex = spark.createDataFrame(SENTIMENT_LEXICON, "token string, polarity double, subjectivity double")
    neg = spark.createDataFrame([(t,) for t in SENTIMENT_NEGATORS], "token string")
    return lex, neg


def _duck_values(rows, cols: str) -> str:
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else repr(v)

    body = ", ".join("(" + ", ".join(lit(v) for v in (r if isinstance(r, tuple) else (r,))) + ")" for r in rows)
    return f"(VALUES {body}) AS v({cols})"


def _duck_sentiment(lexicon) -> str:
    return f"""WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '\\p{{L}}+') AS toks FROM documents),
t AS (SELECT doc_id, unnest(toks) AS token, unnest(list_concat([NULL], toks[1:len(toks) - 1])) AS prev FROM d),
lex AS (SELECT * FROM {_duck_values(lexicon, "token, polarity, subjectivity")}),
neg AS (SELECT * FROM {_duck_values(SENTIMENT_NEGATORS, "ntoken")}),
h AS (SELECT t.doc_id, CASE WHEN neg.ntoken IS NOT NULL THEN lex.polarity * -0.5 ELSE lex.polarity END AS pol,
             lex.subjectivity AS subj
      FROM t JOIN lex ON t.token = lex.token LEFT JOIN neg ON t.prev = neg.ntoken),
a AS (SELECT doc_id, avg(pol) AS polarity, avg(subj) AS subjectivity, count(*) AS n_hits FROM h GROUP BY doc_id)
SELECT d.doc_id, round(coalesce(a.polarity, 0.0), 6) AS polarity, round(coalesce(a.subjectivity, 0.0), 6) AS subjectivity,
       coalesce(a.n_hits, 0) AS n_hits
FROM d LEFT JOIN a USING (doc_id)"""


_DUCK_SENTIMENT = _duck_sentiment(SENTIMENT_LEXICON)


def _sentiment_scores(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    lex, neg = _lexicon(spark)
    return sentiment.sentiment(docs, "doc_id", "text", lex, neg)


@register("text_sentiment", _DUCK_SENTIMENT)
def q_text_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    s = _sentiment_scores(spark, sf)
    return s.select("doc_id", F.round("polarity", 6).alias("polarity"), F.round("subjectivity", 6).alias("subjectivity"), "n_hits")


@register(
    "prompt_sentiment",
    f"""WITH s AS ({_duck_sentiment(TONE_LEXICON)})
SELECT CASE WHEN avg(polarity) > {prompts.TONE_THRESHOLDS[0]} THEN '{prompts.POSITIVE_TONE}'
            WHEN avg(polarity) < {prompts.TONE_THRESHOLDS[1]} THEN '{prompts.SERIOUS_TONE}' END AS suggestion
FROM s HAVING suggestion IS NOT NULL""",
)
def q_prompt_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    neg = _lexicon(spark)[1]
    lex = spark.createDataFrame(TONE_LEXICON, "token string, polarity double, subjectivity double")
    return sentiment.sentiment_prompt(sentiment.sentiment(table(spark, sf, "documents"), "doc_id", "text", lex, neg))


@register(
    "prompt_sentiment_mean",
    f"""WITH s AS ({_DUCK_SENTIMENT}) SELECT round(avg(polarity), 6) AS mean_polarity, count(*) AS num_texts FROM s""",
)
def q_prompt_sentiment_mean(spark: SparkSession, sf: str) -> DataFrame:
    s = _sentiment_scores(spark, sf)
    return s.agg(F.round(F.avg("polarity"), 6).alias("mean_polarity"), F.count(F.lit(1)).alias("num_texts"))


def _duck_matches(source: str, id_col: str, text_col: str, rules) -> str:
    parts = []
    for prio, (label, pattern) in enumerate(rules):
        pat = pattern.replace("'", "''")
        parts.append(
            f"""SELECT {id_col} AS id, {prio} AS priority, '{label}' AS label, match, idx,
       sum(length(gap) + length(match)) OVER (PARTITION BY {id_col} ORDER BY idx) AS end_pos
FROM (SELECT {id_col}, unnest(ms) AS match, unnest(gs[1:len(ms)]) AS gap, generate_subscripts(ms, 1) AS idx
      FROM (SELECT {id_col}, regexp_extract_all(coalesce({text_col}, ''), '{pat}') AS ms,
                   regexp_split_to_array(coalesce({text_col}, ''), '{pat}') AS gs FROM {source}))"""
        )
    return "\nUNION ALL\n".join(parts)


def _duck_resolve(matches_sql: str, n_levels: int) -> str:
    # level by level: a match stays unless a kept one of a higher level overlaps it
    steps = [f"""m AS (SELECT id, priority, label, match, end_pos - length(match) AS start_pos, end_pos
           FROM ({matches_sql}) WHERE length(match) > 0)""", "k0 AS (SELECT *, priority = 0 AS kept FROM m)"]
    for p in range(1, n_levels):
        steps.append(
            f"""w{p} AS (SELECT *, max(CASE WHEN kept THEN end_pos END) OVER (PARTITION BY id ORDER BY start_pos
              RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS e,
           min(CASE WHEN kept THEN start_pos END) OVER (PARTITION BY id ORDER BY start_pos
              RANGE BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS s FROM k{p - 1}),
k{p} AS (SELECT id, priority, label, match, start_pos, end_pos,
           CASE WHEN priority = {p} THEN coalesce(e, -1) <= start_pos AND coalesce(s, 2147483647) >= end_pos ELSE kept END AS kept FROM w{p})"""
        )
    return f"""WITH {", ".join(steps)}
SELECT id, start_pos, end_pos, label, match AS text FROM k{n_levels - 1} WHERE kept"""


@register(
    "text_entities",
    _duck_resolve(_duck_matches("documents", "doc_id", "text", ENTITY_RULES), len(ENTITY_RULES)).replace(
        "SELECT id, start_pos", "SELECT id AS doc_id, start_pos", 1
    ),
)
def q_text_entities(spark: SparkSession, sf: str) -> DataFrame:
    e = entities.extract_entities(table(spark, sf, "documents"), "doc_id", "text")
    return e.select("doc_id", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"), "label", "text")


@register(
    "text_entities_urls",
    _duck_resolve(_duck_matches("pages", "page_id", "url", ENTITY_RULES), len(ENTITY_RULES)).replace(
        "SELECT id, start_pos", "SELECT id AS page_id, start_pos", 1
    ),
)
def q_text_entities_urls(spark: SparkSession, sf: str) -> DataFrame:
    e = entities.extract_entities(table(spark, sf, "pages"), "page_id", "url")
    return e.select("page_id", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"), "label", "text")


def _gazetteer(spark: SparkSession, sf: str) -> DataFrame:
    r = table(spark, sf, "region").select(F.col("r_name").alias("token"))
    n = table(spark, sf, "nation").select(F.col("n_name").alias("token"))
    return r.unionByName(n).withColumn("label", F.lit("GPE"))


_GAZ_RULES = ENTITY_RULES + (("GPE_TOKEN", r"\p{L}+"),)
_DUCK_GAZ_MATCHES = _duck_matches("pages", "page_id", "html", _GAZ_RULES)
_DUCK_GAZ = (
    _duck_resolve(
        f"""SELECT id, priority, label, match, idx, end_pos FROM ({_DUCK_GAZ_MATCHES}) WHERE priority < {len(ENTITY_RULES)}
UNION ALL
SELECT g.id, g.priority, 'GPE' AS label, g.match, g.idx, g.end_pos FROM ({_DUCK_GAZ_MATCHES}) g
JOIN (SELECT DISTINCT lower(r_name) AS tok FROM region UNION SELECT DISTINCT lower(n_name) FROM nation) z
  ON lower(g.match) = z.tok WHERE g.priority = {len(ENTITY_RULES)}""",
        len(_GAZ_RULES),
    ).replace("SELECT id, start_pos", "SELECT id AS page_id, start_pos", 1)
)


@register("text_entities_gazetteer", _DUCK_GAZ)
def q_text_entities_gazetteer(spark: SparkSession, sf: str) -> DataFrame:
    e = entities.extract_entities(table(spark, sf, "pages"), "page_id", "html", gazetteer=_gazetteer(spark, sf))
    return e.select("page_id", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"), "label", "text")


@register(
    "prompt_entities",
    f"SELECT DISTINCT '{prompts.ENTITY_TEMPLATE[0]}' || lower(label) || '{prompts.ENTITY_TEMPLATE[1]}' AS suggestion FROM ("
    + _duck_resolve(_duck_matches("documents", "doc_id", "text", ENTITY_RULES), len(ENTITY_RULES))
    + ")",
)
def q_prompt_entities(spark: SparkSession, sf: str) -> DataFrame:
    return entities.entity_prompts(entities.extract_entities(table(spark, sf, "documents"), "doc_id", "text"))


@register("text_entities_tagged", None)
def q_text_entities_tagged(spark: SparkSession, sf: str) -> DataFrame:
    # learnt from the rules' spans in a sample, then tagged in every document
    docs = table(spark, sf, "documents")
    model = tagger.fit(tagger.labelled_by_rules(docs, "doc_id", "text"))
    e = tagger.tagged(docs, "doc_id", "text", model)
    return e.select("doc_id", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"), "label", "text")


@register(
    "batch_model_inference",
    """SELECT doc_id, CAST(length(coalesce(text, '')) AS DOUBLE) AS length_feature,
       CAST(length(coalesce(text, '')) - length(replace(coalesce(text, ''), ' ', '')) AS DOUBLE) AS blanks_feature
FROM documents""",
)
def q_batch_model_inference(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = inference.batch_model_inference(docs, "text", inference.text_stats_model, "vector", batch_size=32)
    return out.select("doc_id", F.col("vector")[0].cast("double").alias("length_feature"),
                      F.col("vector")[1].cast("double").alias("blanks_feature"))


@register("custom_extractor", "SELECT item_id, CAST(length(coalesce(text, '')) AS BIGINT) AS text_length FROM benchmark")
def q_custom_extractor(spark: SparkSession, sf: str) -> DataFrame:
    b = table(spark, sf, "benchmark")
    return inference.apply_extractor(b, "TEXT_LENGTH", "text", "text_length").select("item_id", "text_length")


@register("text_topics", None)
def q_text_topics(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return topics.describe_topics(docs, "doc_id", "text", k=5, terms=10, seed=7, max_iter=10)


@register("prompt_topics", None)
def q_prompt_topics(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return topics.topic_prompts(topics.describe_topics(docs, "doc_id", "text", k=5, terms=10, seed=7, max_iter=10))


# ---------------------------------------------------------------- images
# Every part row is one synthetic raster image (fixture formula in pixels.synthetic_raster).
from sparkloom.functions.image import analysis, assemble, raster  # noqa: E402
from sparkloom.functions.image.pixels import DUCK_GRAY, duck_raster, synthetic_raster  # noqa: E402
from sparkloom.sources import png  # noqa: E402

_IMG = f"""p AS {duck_raster("SELECT p_partkey AS image_id FROM part")},
g AS (SELECT *, {DUCK_GRAY} AS gray FROM p),
dims AS (SELECT image_id, max(x) + 1 AS width, max(y) + 1 AS height,
                (max(x) + 1) / (max(y) + 1) AS aspect_ratio,
                CASE WHEN max(x) > max(y) THEN 'landscape' ELSE 'portrait' END AS orientation FROM p GROUP BY image_id),
sty AS (SELECT image_id, sum(r + g + b) / (count(*) * 3.0) AS brightness,
               sqrt(greatest(sum(r * r + g * g + b * b) / (count(*) * 3.0) - pow(sum(r + g + b) / (count(*) * 3.0), 2), 0)) AS pixel_std,
               avg(sqrt(greatest((r * r + g * g + b * b) / 3.0 - pow((r + g + b) / 3.0, 2), 0))) AS saturation,
               var_pop(r) AS var_r, var_pop(g) AS var_g, var_pop(b) AS var_b FROM p GROUP BY image_id),
pairs AS (SELECT * FROM (SELECT image_id, y, x, gray AS a, lead(gray) OVER (PARTITION BY image_id, y ORDER BY x) AS b FROM g)
          WHERE b IS NOT NULL),
cells AS (SELECT image_id, i, j, count(*) AS c FROM (SELECT image_id, a AS i, b AS j FROM pairs UNION ALL
                                                     SELECT image_id, b, a FROM pairs) GROUP BY ALL),
tex AS (SELECT s.image_id, s.tc AS texture_contrast, sqrt(e.sc) / (2.0 * s.n) AS energy, s.hom AS homogeneity
        FROM (SELECT image_id, count(*) AS n, avg((a - b) * (a - b)) AS tc, avg(1.0 / (1 + (a - b) * (a - b))) AS hom
              FROM pairs GROUP BY image_id) s
        JOIN (SELECT image_id, sum(c * c) AS sc FROM cells GROUP BY image_id) e USING (image_id)),
hp AS (SELECT image_id, x, y,
              coalesce(lead(gray) OVER wr, gray) - coalesce(lag(gray) OVER wr, gray) AS dx,
              coalesce(lag(gray) OVER wr, gray) + 2 * gray + coalesce(lead(gray) OVER wr, gray) AS sx
       FROM g WINDOW wr AS (PARTITION BY image_id, y ORDER BY x)),
edges AS (SELECT image_id, avg(sqrt(pow(coalesce(lag(dx) OVER wc, dx) + 2 * dx + coalesce(lead(dx) OVER wc, dx), 2)
                               + pow(coalesce(lead(sx) OVER wc, sx) - coalesce(lag(sx) OVER wc, sx), 2))) AS edge_density
          FROM hp WINDOW wc AS (PARTITION BY image_id, x ORDER BY y) GROUP BY image_id),
focal AS (SELECT f.image_id, f.x / d.width AS focal_x, f.y / d.height AS focal_y
          FROM (SELECT image_id, x, y, row_number() OVER (PARTITION BY image_id ORDER BY gray DESC, y, x) AS rn FROM g) f
          JOIN dims d USING (image_id) WHERE rn = 1),
aes AS (SELECT a.image_id, a.aesthetic_score, a.sharpness, coalesce(c.complexity, 0.0) AS complexity
        FROM (SELECT image_id, avg((r + g + b) / 3.0) / 255.0 AS aesthetic_score, stddev_pop(gray) AS sharpness FROM g GROUP BY image_id) a
        LEFT JOIN (SELECT image_id, avg(abs(b - a)) AS complexity FROM pairs GROUP BY image_id) c USING (image_id))"""


def _duck_edges_fix(sql: str) -> str:
    # DuckDB cannot nest a window inside an aggregate; compute magnitudes first
    return sql.replace(
        """edges AS (SELECT image_id, avg(sqrt(pow(coalesce(lag(dx) OVER wc, dx) + 2 * dx + coalesce(lead(dx) OVER wc, dx), 2)
                               + pow(coalesce(lead(sx) OVER wc, sx) - coalesce(lag(sx) OVER wc, sx), 2))) AS edge_density
          FROM hp WINDOW wc AS (PARTITION BY image_id, x ORDER BY y) GROUP BY image_id)""",
        """mags AS (SELECT image_id, sqrt(pow(coalesce(lag(dx) OVER wc, dx) + 2 * dx + coalesce(lead(dx) OVER wc, dx), 2)
                              + pow(coalesce(lead(sx) OVER wc, sx) - coalesce(lag(sx) OVER wc, sx), 2)) AS mag
          FROM hp WINDOW wc AS (PARTITION BY image_id, x ORDER BY y)),
edges AS (SELECT image_id, avg(mag) AS edge_density FROM mags GROUP BY image_id)""",
    )


_IMG = _duck_edges_fix(_IMG)


def _pixels(spark: SparkSession, sf: str) -> DataFrame:
    return synthetic_raster(table(spark, sf, "part"), "p_partkey")


def _rasters(spark: SparkSession, sf: str) -> DataFrame:
    return raster.synthetic(table(spark, sf, "part"), "p_partkey")


def _r(c: str, digits: int = 6):
    return F.round(F.col(c), digits).alias(c)


@register("image_pixels", f"WITH {_IMG} SELECT image_id, x, y, r, g, b FROM p")
def q_image_pixels(spark: SparkSession, sf: str) -> DataFrame:
    return _pixels(spark, sf)


@register(
    "image_dimensions",
    f"WITH {_IMG} SELECT image_id, width, height, round(aspect_ratio, 6) AS aspect_ratio, orientation FROM dims",
)
def q_image_dimensions(spark: SparkSession, sf: str) -> DataFrame:
    d = analysis.dimensions(_pixels(spark, sf))
    return d.select("image_id", "width", "height", _r("aspect_ratio"), "orientation")


@register(
    "image_style",
    f"""WITH {_IMG} SELECT image_id, round(brightness, 6) AS brightness, round(pixel_std, 6) AS pixel_std,
round(saturation, 6) AS saturation, round(var_r, 4) AS var_r, round(var_g, 4) AS var_g, round(var_b, 4) AS var_b FROM sty""",
)
def q_image_style(spark: SparkSession, sf: str) -> DataFrame:
    s = analysis.style(_pixels(spark, sf))
    return s.select("image_id", _r("brightness"), _r("pixel_std"), _r("saturation"), _r("var_r", 4), _r("var_g", 4), _r("var_b", 4))


@register(
    "image_texture",
    f"""WITH {_IMG} SELECT image_id, round(texture_contrast, 6) AS texture_contrast, round(energy, 6) AS energy,
round(homogeneity, 6) AS homogeneity FROM tex""",
)
def q_image_texture(spark: SparkSession, sf: str) -> DataFrame:
    t = raster.measures(_rasters(spark, sf))
    return t.select("image_id", _r("texture_contrast"), _r("energy"), _r("homogeneity"))


@register("image_edge_density", f"WITH {_IMG} SELECT image_id, round(edge_density, 6) AS edge_density FROM edges")
def q_image_edge_density(spark: SparkSession, sf: str) -> DataFrame:
    return raster.measures(_rasters(spark, sf)).select("image_id", _r("edge_density"))


@register("image_focal_point", f"WITH {_IMG} SELECT image_id, round(focal_x, 6) AS focal_x, round(focal_y, 6) AS focal_y FROM focal")
def q_image_focal_point(spark: SparkSession, sf: str) -> DataFrame:
    return analysis.focal_point(_pixels(spark, sf)).select("image_id", _r("focal_x"), _r("focal_y"))


@register(
    "image_aesthetics",
    f"""WITH {_IMG} SELECT image_id, round(aesthetic_score, 6) AS aesthetic_score, round(sharpness, 6) AS sharpness,
round(complexity, 6) AS complexity FROM aes""",
)
def q_image_aesthetics(spark: SparkSession, sf: str) -> DataFrame:
    a = raster.measures(_rasters(spark, sf))
    return a.select("image_id", _r("aesthetic_score"), _r("sharpness"), _r("complexity"))


def _duck_kmeans(k: int = 5, rounds: int = 5, source: str = "p") -> str:
    ctes = [
        f"colors AS (SELECT image_id, r, g, b, count(*) AS cnt FROM {source} GROUP BY ALL)",
        """bins AS (SELECT image_id, (r >> 5) * 64 + (g >> 5) * 8 + (b >> 5) AS bin, sum(cnt) AS n,
                 sum(cnt * r) / sum(cnt) AS cr, sum(cnt * g) / sum(cnt) AS cg, sum(cnt * b) / sum(cnt) AS cb
          FROM colors GROUP BY ALL)""",
        f"""c0 AS (SELECT image_id, k, cr, cg, cb FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY n DESC, bin) - 1 AS k
                                                 FROM bins) WHERE k < {k})""",
    ]

    def assign_sql(i: int) -> str:
        return f"""a{i} AS (SELECT image_id, r, g, b, cnt, k FROM (
              SELECT c.image_id, c.r, c.g, c.b, c.cnt, z.k, row_number() OVER (
                PARTITION BY c.image_id, c.r, c.g, c.b
                ORDER BY (c.r - z.cr) * (c.r - z.cr) + (c.g - z.cg) * (c.g - z.cg) + (c.b - z.cb) * (c.b - z.cb), z.k) AS rn
              FROM colors c JOIN c{i} z USING (image_id)) WHERE rn = 1)"""

    for i in range(rounds):
        ctes.append(assign_sql(i))
        ctes.append(
            f"""c{i + 1} AS (SELECT o.image_id, o.k, coalesce(s.nr, o.cr) AS cr, coalesce(s.ng, o.cg) AS cg, coalesce(s.nb, o.cb) AS cb
          FROM c{i} o LEFT JOIN (SELECT image_id, k, sum(cnt * r) / sum(cnt) AS nr, sum(cnt * g) / sum(cnt) AS ng,
                                        sum(cnt * b) / sum(cnt) AS nb FROM a{i} GROUP BY ALL) s USING (image_id, k))"""
        )
    ctes.append(assign_sql(rounds))
    ctes.append(
        f"""pal AS (SELECT s.image_id, row_number() OVER (PARTITION BY s.image_id ORDER BY s.n DESC, s.k) - 1 AS rank,
                '#' || printf('%02x', floor(c.cr)::INT) || printf('%02x', floor(c.cg)::INT) || printf('%02x', floor(c.cb)::INT) AS color_hex,
                s.n / t.total AS weight
         FROM (SELECT image_id, k, sum(cnt) AS n FROM a{rounds} GROUP BY ALL) s
         JOIN c{rounds} c USING (image_id, k)
         JOIN (SELECT image_id, sum(cnt) AS total FROM a{rounds} GROUP BY image_id) t USING (image_id))"""
    )
    return ",\n".join(ctes)


_PAL = f"WITH {_IMG},\n{_duck_kmeans()}"


@register("image_color_palette", f"{_PAL} SELECT image_id, rank, color_hex, round(weight, 6) AS weight FROM pal")
def q_image_color_palette(spark: SparkSession, sf: str) -> DataFrame:
    p = raster.color_palette(_rasters(spark, sf))
    return p.select("image_id", "rank", "color_hex", _r("weight"))


@register(
    "image_color_stats",
    f"""{_PAL}, div AS (SELECT image_id, sqrt(greatest(sum(weight * rank * rank) - pow(sum(weight * rank), 2), 0)) AS color_diversity
                      FROM pal GROUP BY image_id)
SELECT image_id, round(avg(r), 6) AS mean_r, round(avg(g), 6) AS mean_g, round(avg(b), 6) AS mean_b,
       round(stddev_pop(r), 6) AS std_r, round(stddev_pop(g), 6) AS std_g, round(stddev_pop(b), 6) AS std_b,
       round(any_value(div.color_diversity), 6) AS color_diversity
FROM p JOIN div USING (image_id) GROUP BY image_id""",
)
def q_image_color_stats(spark: SparkSession, sf: str) -> DataFrame:
    s = raster.color_stats(_rasters(spark, sf))
    return s.select("image_id", *[_r(c) for c in ("mean_r", "mean_g", "mean_b", "std_r", "std_g", "std_b", "color_diversity")])


_ALL = ("COMPOSITION", "STYLE", "AESTHETICS")
_VEC = f"""WITH {_IMG}, v AS (
  SELECT image_id, [aspect_ratio, edge_density, brightness, texture_contrast, saturation, var_r, var_g, var_b,
                    aesthetic_score, sharpness, complexity]::DOUBLE[] AS vec,
         [brightness, texture_contrast, saturation, texture_contrast, energy, homogeneity]::DOUBLE[] AS svec
  FROM dims JOIN edges USING (image_id) JOIN sty USING (image_id) JOIN tex USING (image_id) JOIN aes USING (image_id))"""


@register(
    "visual_feature_vector",
    f"{_VEC} SELECT image_id, generate_subscripts(vec, 1) - 1 AS dim, round(unnest(vec), 4) AS value FROM v",
)
def q_visual_feature_vector(spark: SparkSession, sf: str) -> DataFrame:
    from sparkloom.operators.combine import long_form

    f = assemble.analyze_images(_rasters(spark, sf), _ALL)
    return long_form(assemble.visual_feature_vector(f, _ALL), "image_id", "visual_features", 4)


@register(
    "style_vector",
    f"{_VEC} SELECT image_id, generate_subscripts(svec, 1) - 1 AS dim, round(unnest(svec), 6) AS value FROM v",
)
def q_style_vector(spark: SparkSession, sf: str) -> DataFrame:
    from sparkloom.operators.combine import long_form

    f = assemble.analyze_images(_rasters(spark, sf), ("STYLE",))
    return long_form(assemble.style_vector(f), "image_id", "style_vector", 6)


@register(
    "suggested_params",
    f"""WITH {_IMG} SELECT image_id, round(aspect_ratio, 6) AS aspect_ratio, orientation, round(brightness, 6) AS brightness,
round(texture_contrast, 6) AS contrast, round(saturation, 6) AS saturation, round(aesthetic_score, 6) AS target_score,
round(sharpness, 6) AS sharpness FROM dims JOIN sty USING (image_id) JOIN tex USING (image_id) JOIN aes USING (image_id)""",
)
def q_suggested_params(spark: SparkSession, sf: str) -> DataFrame:
    f = assemble.analyze_images(_rasters(spark, sf), _ALL)
    s = assemble.suggested_params(f)
    return s.select(
        "image_id", F.round("composition.aspect_ratio", 6).alias("aspect_ratio"), F.col("composition.orientation").alias("orientation"),
        F.round("style.brightness", 6).alias("brightness"), F.round("style.contrast", 6).alias("contrast"),
        F.round("style.saturation", 6).alias("saturation"), F.round("quality.target_score", 6).alias("target_score"),
        F.round("quality.sharpness", 6).alias("sharpness"),
    )


_DUCK_BOXES = f"""WITH RECURSIVE {_IMG},
n AS (SELECT image_id, count(*) AS n FROM g GROUP BY image_id),
lit AS (SELECT image_id, x, y, y * 4096 + x AS id FROM g WHERE gray > {raster.BRIGHT}),
near AS (SELECT a.image_id, a.id AS a, b.id AS b FROM lit a JOIN lit b
  ON a.image_id = b.image_id AND ((a.x = b.x AND abs(a.y - b.y) = 1) OR (a.y = b.y AND abs(a.x - b.x) = 1))),
reach AS (SELECT image_id, id, id AS seen FROM lit UNION SELECT r.image_id, r.id, e.b FROM reach r JOIN near e ON r.image_id = e.image_id AND r.seen = e.a),
part_of AS (SELECT image_id, id, min(seen) AS root FROM reach GROUP BY image_id, id),
box AS (SELECT l.image_id, min(x) AS x1, min(y) AS y1, max(x) + 1 AS x2, max(y) + 1 AS y2, count(*) AS pixels
  FROM lit l JOIN part_of p ON l.image_id = p.image_id AND l.id = p.id GROUP BY l.image_id, p.root HAVING count(*) >= {raster.LEAST_PIXELS}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY pixels DESC, y1, x1) AS place FROM box),
over AS (SELECT b.image_id, b.place, a.place AS better FROM ranked b JOIN ranked a ON a.image_id = b.image_id AND a.place < b.place
  WHERE greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0, least(a.y2, b.y2) - greatest(a.y1, b.y1)) * (1 + {raster.OVERLAP})
        > {raster.OVERLAP} * ((a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1))),
settled AS (SELECT image_id, place, 0 AS step, [place] AS kept FROM ranked WHERE place = 1
  UNION ALL SELECT s.image_id, r.place, s.step + 1,
    CASE WHEN EXISTS (SELECT 1 FROM over o WHERE o.image_id = r.image_id AND o.place = r.place AND list_contains(s.kept, o.better)) THEN s.kept
         ELSE list_append(s.kept, r.place) END
  FROM settled s JOIN ranked r ON r.image_id = s.image_id AND r.place = s.place + 1),
final AS (SELECT image_id, unnest(kept) AS place FROM (SELECT image_id, arg_max(kept, place) AS kept FROM settled GROUP BY image_id))
SELECT r.image_id, CAST(row_number() OVER (PARTITION BY r.image_id ORDER BY r.place) - 1 AS INTEGER) AS rank, x1::DOUBLE AS x1, y1::DOUBLE AS y1,
       x2::DOUBLE AS x2, y2::DOUBLE AS y2, 1 AS label, round(pixels / n.n, 6) AS score
FROM ranked r JOIN final f ON r.image_id = f.image_id AND r.place = f.place JOIN n ON n.image_id = r.image_id"""


@register("image_objects", _DUCK_BOXES)
def q_image_objects(spark: SparkSession, sf: str) -> DataFrame:
    return raster.detect_objects(_rasters(spark, sf)).withColumn("score", F.round("score", 6))


@register("image_bytes_pixels", f"WITH {_IMG} SELECT image_id, x, y, r, g, b FROM p")
def q_image_bytes_pixels(spark: SparkSession, sf: str) -> DataFrame:
    # the rasters as PNG bytes in a column (every row filter), decoded again
    return raster.pixels(png.rasters(png.encoded(_rasters(spark, sf)), "image_id"))


_DUCK_DEFAULTS = f"""WITH {_IMG}, ok AS (SELECT p_partkey AS image_id FROM part WHERE p_size <= 45),
ids AS (SELECT p_partkey AS image_id FROM part)
SELECT ids.image_id, coalesce(round(d.aspect_ratio, 6), 1.0) AS aspect_ratio, coalesce(d.orientation, 'unknown') AS orientation,
       coalesce(round(e.edge_density, 6), 0.0) AS edge_density, coalesce(round(f.focal_x, 6), 0.5) AS focal_x,
       coalesce(round(s.brightness, 6), 0.0) AS brightness
FROM ids LEFT JOIN (SELECT * FROM dims WHERE image_id IN (SELECT image_id FROM ok)) d USING (image_id)
LEFT JOIN (SELECT * FROM edges WHERE image_id IN (SELECT image_id FROM ok)) e USING (image_id)
LEFT JOIN (SELECT * FROM focal WHERE image_id IN (SELECT image_id FROM ok)) f USING (image_id)
LEFT JOIN (SELECT * FROM sty WHERE image_id IN (SELECT image_id FROM ok)) s USING (image_id)"""


@register("image_default_on_error", _DUCK_DEFAULTS)
def q_image_default_on_error(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    # parts with p_size > 45 stand for files that failed to decode: listed, but without pixels
    decoded = raster.synthetic(part.filter(F.col("p_size") <= 45), "p_partkey")
    ids = part.select(F.col("p_partkey").alias("image_id"))
    f = assemble.analyze_images(decoded, ("COMPOSITION", "STYLE"), ids=ids)
    return f.select("image_id", _r("aspect_ratio"), "orientation", _r("edge_density"), _r("focal_x"), _r("brightness"))


@register("image_bytes_default_on_error", _DUCK_DEFAULTS)
def q_image_bytes_default_on_error(spark: SparkSession, sf: str) -> DataFrame:
    # the PNG bytes of parts with p_size > 45 are cut short
    part = table(spark, sf, "part").select(F.col("p_partkey").cast("bigint").alias("image_id"), "p_size")
    ids = part.select("image_id")
    # a merge join: files of ids are small, so Spark would broadcast every row; and before there are images, whose size it doesn't know
    sized = ids.join(part.hint("merge"), "image_id")
    images = png.encoded(raster.synthetic(sized, "image_id", keep=("p_size",)), keep=("p_size",))
    cut = F.when(F.col("p_size") > 45, F.substring("image_data", 1, 40)).otherwise(F.col("image_data"))
    f = assemble.analyze_images(png.rasters(images.withColumn("image_data", cut), "image_id"), ("COMPOSITION", "STYLE"), ids=ids)
    return f.select("image_id", _r("aspect_ratio"), "orientation", _r("edge_density"), _r("focal_x"), _r("brightness"))


def _duck_weights(size_col: str, target: int) -> str:
    """Bicubic weights (target place i, source place j, fixed-point weight) for the sizes in ``size_col`` of ``sizes``."""
    centre, wide = f"((i + 0.5) * {size_col} / {target}.0)", f"greatest({size_col} / {target}.0, 1.0)"
    return f"""(SELECT {size_col}, i, j, CAST(CASE WHEN v < 0 THEN ceil(v * {1 << raster.FRACTION} - 0.5) ELSE floor(v * {1 << raster.FRACTION} + 0.5) END AS BIGINT) AS k
  FROM (SELECT {size_col}, i, j, wt / sum(wt) OVER (PARTITION BY {size_col}, i) AS v FROM (
    SELECT {size_col}, i, j, CASE WHEN d < 1 THEN (1.5 * d - 2.5) * d * d + 1.0 WHEN d < 2 THEN ((-0.5 * d + 2.5) * d - 4.0) * d + 2.0 ELSE 0.0 END AS wt
    FROM (SELECT {size_col}, i, j, abs((j - {centre} + 0.5) / {wide}) AS d
      FROM (SELECT {size_col}, i, unnest(range({size_col})) AS j FROM (SELECT DISTINCT {size_col} FROM sizes), (SELECT unnest(range({target})) AS i))
      WHERE j >= CAST(trunc({centre} - 2.0 * {wide} + 0.5) AS BIGINT) AND j < CAST(trunc({centre} + 2.0 * {wide} + 0.5) AS BIGINT)))))"""


def _duck_resized(source: str, width: int, height: int) -> str:
    half = 1 << (raster.FRACTION - 1)
    cut = lambda c, t: f"greatest(0, least(255, (CAST(sum({t}.k * {c}) AS BIGINT) + {half}) >> {raster.FRACTION})) AS {c}"
    return f"""sizes AS (SELECT image_id, max(x) + 1 AS w, max(y) + 1 AS h FROM {source} GROUP BY image_id),
wx AS {_duck_weights("w", width)}, wy AS {_duck_weights("h", height)},
across AS (SELECT image_id, wx.i AS x, y, {", ".join(cut(c, "wx") for c in "rgb")} FROM {source} JOIN sizes USING (image_id) JOIN wx ON wx.w = sizes.w AND wx.j = x GROUP BY ALL),
small AS (SELECT image_id, x, wy.i AS y, {", ".join(cut(c, "wy") for c in "rgb")} FROM across JOIN sizes USING (image_id) JOIN wy ON wy.h = sizes.h AND wy.j = y GROUP BY ALL)"""


@register("image_resize", f"WITH {_IMG}, {_duck_resized('p', 10, 9)} SELECT image_id, x, y, r, g, b FROM small")
def q_image_resize(spark: SparkSession, sf: str) -> DataFrame:
    # the rasters are small, so the target is smaller than the default of 150 x 150
    return raster.pixels(raster.resized(_rasters(spark, sf), 10, 9))


@register(
    "image_color_palette_resized",
    f"WITH {_IMG}, {_duck_resized('p', 10, 9)},\n{_duck_kmeans(source='small')} SELECT image_id, rank, color_hex, round(weight, 6) AS weight FROM pal",
)
def q_image_color_palette_resized(spark: SparkSession, sf: str) -> DataFrame:
    p = raster.color_palette(_rasters(spark, sf), size=(10, 9))
    return p.select("image_id", "rank", "color_hex", _r("weight"))


# ---------------------------------------------------------------- keywords
from sparkloom.functions.text import keywords as kw  # noqa: E402

_STOP_SQL = ", ".join(f"'{w}'" for w in kw.STOP_WORDS)
_DUCK_TERM_SCORES = rf"""WITH d AS (SELECT doc_id, text FROM documents),
s AS (SELECT doc_id, generate_subscripts(ss, 1) - 1 AS s, unnest(ss) AS sentence
      FROM (SELECT doc_id, regexp_split_to_array(coalesce(text, ''), '[.!?\n]+') AS ss FROM d)),
w AS (SELECT doc_id, s, ws, lw
      FROM (SELECT doc_id, s, regexp_extract_all(sentence, '\p{{L}}+') AS ws,
                   regexp_extract_all(lower(sentence), '\p{{L}}+') AS lw FROM s) WHERE len(ws) > 0),
ns AS (SELECT doc_id, count(*) AS n_sent FROM w GROUP BY doc_id),
t AS (SELECT doc_id, s, generate_subscripts(ws, 1) - 1 AS i, unnest(ws) AS word, unnest(lw) AS term,
             unnest(list_concat([NULL], lw[1:len(lw) - 1])) AS prev, unnest(list_concat(lw[2:], [NULL])) AS nxt FROM w),
f AS (SELECT *, (word = upper(word) AND length(word) > 1 AND word <> lower(word)) AS acronym,
             (substr(word, 1, 1) = upper(substr(word, 1, 1)) AND substr(word, 1, 1) <> lower(substr(word, 1, 1))) AS capital
      FROM t WHERE term NOT IN ({_STOP_SQL})),
st AS (SELECT doc_id, term, count(*) AS tf, count_if(acronym) AS tf_a, count_if(capital AND NOT acronym AND i > 0) AS tf_u,
              median(s) AS med_s, count(DISTINCT s) AS n_sent_t, count(prev) AS n_left, count(DISTINCT prev) AS d_left,
              count(nxt) AS n_right, count(DISTINCT nxt) AS d_right FROM f GROUP BY doc_id, term),
dc AS (SELECT doc_id, avg(tf) AS mean_tf, stddev_pop(tf) AS std_tf, max(tf) AS max_tf FROM st GROUP BY doc_id),
j AS (SELECT st.*, dc.mean_tf, dc.std_tf, dc.max_tf, ns.n_sent,
             CASE WHEN n_left > 0 THEN d_left / n_left ELSE 0.0 END AS dl,
             CASE WHEN n_right > 0 THEN d_right / n_right ELSE 0.0 END AS dr
      FROM st JOIN dc USING (doc_id) JOIN ns USING (doc_id)),
r AS (SELECT doc_id, term, tf, 1.0 + (dl + dr) * tf / max_tf AS rel, greatest(tf_a, tf_u) / (1.0 + ln(tf)) AS cas,
             ln(ln(3.0 + med_s)) AS pos, tf / (mean_tf + std_tf) AS freq, n_sent_t / n_sent AS sent FROM j)
SELECT doc_id, term, tf, round(rel * pos / (cas + freq / rel + sent / rel), 6) AS score FROM r"""


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "text")


@register("text_keyword_terms", _DUCK_TERM_SCORES)
def q_text_keyword_terms(spark: SparkSession, sf: str) -> DataFrame:
    s = kw.term_scores(_docs(spark, sf), "doc_id", "text")
    return s.select("doc_id", "term", "tf", F.round("score", 6).alias("score"))


# ---------------------------------------------------------------- sample data and summaries
from sparkloom.functions.text.extract import text_feature_summary  # noqa: E402
from sparkloom.sources import sample  # noqa: E402


def _duck_hash(field: str) -> str:
    return f"('0x' || substr(md5('0|{field}|' || CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT"


def _duck_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_DUCK_SAMPLE = f"""SELECT doc_id AS id,
  {_duck_list(sample.SCENES)}[{_duck_hash('scene')} % {len(sample.SCENES)} + 1] || ' ' ||
  {_duck_list(sample.STYLES)}[{_duck_hash('style')} % {len(sample.STYLES)} + 1] AS description,
  round(0.5 + ({_duck_hash('strength')} % 100000) / 100000.0 * 0.5, 6) AS strength,
  round(0.1 + ({_duck_hash('noise')} % 100000) / 100000.0 * 0.4, 6) AS noise,
  round(0.8 + ({_duck_hash('contrast')} % 100000) / 100000.0 * 0.4, 6) AS contrast,
  list_transform(list_sort([{", ".join(f"{{'h': {_duck_hash('tag:' + t)}, 't': '{t}'}}" for t in sample.TAGS)}])[1:3],
                 lambda e: e.t) AS tags
FROM documents"""


@register("generate_sample", _DUCK_SAMPLE)
def q_generate_sample(spark: SparkSession, sf: str) -> DataFrame:
    s = sample.generate_sample(table(spark, sf, "documents"), "doc_id", seed=0)
    m = F.from_json("metadata", sample.SAMPLE_METADATA_SCHEMA)
    return s.select(
        "id", "description",
        F.round(m["style_params"]["strength"], 6).alias("strength"),
        F.round(m["style_params"]["noise"], 6).alias("noise"),
        F.round(m["style_params"]["contrast"], 6).alias("contrast"),
        m["tags"].alias("tags"),
    )


_DUCK_SUMMARY = """SELECT '{kind}' AS extraction_type, count(*) AS num_texts, count_if(length(coalesce(text, '')) > 0) AS non_empty_texts,
       CAST({keywords} AS INTEGER) AS max_keywords, CAST({rows} AS BIGINT) AS shape_rows, CAST({columns} AS INTEGER) AS shape_columns,
       CAST({model} AS VARCHAR) AS model, CAST(NULL AS BIGINT) AS num_topics FROM documents"""


@register(
    "feature_summary",
    "\nUNION ALL\n".join([
        _DUCK_SUMMARY.format(kind="SENTIMENT", keywords="NULL", rows="NULL", columns="NULL", model="NULL"),
        _DUCK_SUMMARY.format(kind="KEYWORDS", keywords=10, rows="NULL", columns="NULL", model="NULL"),
        _DUCK_SUMMARY.format(kind="SEMANTIC_VECTORS", keywords="NULL", rows=r"count_if(regexp_matches(coalesce(text, ''), '\p{L}'))", columns=256, model="'hashed-tfidf'"),
    ]),
)
def q_feature_summary(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    dense = vectors.dense_tfidf(docs, "doc_id", "text", 256)
    parts = [
        text_feature_summary(docs, "text", "SENTIMENT"), text_feature_summary(docs, "text", "KEYWORDS"),
        text_feature_summary(docs, "text", "SEMANTIC_VECTORS", features=dense, model="hashed-tfidf"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).drop("processing_time")


_DUCK_CANDIDATES = (
    _DUCK_TERM_SCORES.rsplit("SELECT doc_id, term, tf, round(", 1)[0]
    + rf""", sc AS (SELECT doc_id, term, tf, rel * pos / (cas + freq / rel + sent / rel) AS score FROM r),
grams AS (SELECT doc_id, unnest(list_concat(
            list_transform(range(1, len(lw) + 1), lambda i: lw[i:i]),
            list_transform(range(1, len(lw)), lambda i: lw[i:i + 1]),
            list_transform(range(1, len(lw) - 1), lambda i: lw[i:i + 2]))) AS g FROM w),
cands AS (SELECT doc_id, array_to_string(g, ' ') AS keyword, any_value(g) AS g, count(*) AS kf FROM grams
          WHERE g[1] NOT IN ({_STOP_SQL}) AND g[-1] NOT IN ({_STOP_SQL}) GROUP BY doc_id, keyword),
comp AS (SELECT doc_id, keyword, kf, g, unnest(g) AS t, generate_subscripts(g, 1) AS j FROM cands),
comp2 AS (SELECT doc_id, keyword, kf, t, CASE WHEN j > 1 THEN g[j - 1] END AS a, CASE WHEN j < len(g) THEN g[j + 1] END AS b,
                 t IN ({_STOP_SQL}) AS stop FROM comp),
big AS (SELECT doc_id, term AS x, nxt AS y, count(*) AS cxy FROM t WHERE nxt IS NOT NULL GROUP BY ALL),
uni AS (SELECT doc_id, term AS u, count(*) AS cu FROM t GROUP BY ALL),
plain AS (SELECT c.doc_id, c.keyword, c.kf, ln(sc.score) AS log_f, sc.score AS addv
          FROM comp2 c JOIN sc ON c.doc_id = sc.doc_id AND c.t = sc.term WHERE NOT c.stop),
stops AS (SELECT c.doc_id, c.keyword, c.kf,
                 (coalesce(b1.cxy, 0) / ua.cu) * (coalesce(b2.cxy, 0) / ut.cu) AS pp
          FROM comp2 c
          LEFT JOIN big b1 ON b1.doc_id = c.doc_id AND b1.x = c.a AND b1.y = c.t
          LEFT JOIN big b2 ON b2.doc_id = c.doc_id AND b2.x = c.t AND b2.y = c.b
          LEFT JOIN uni ua ON ua.doc_id = c.doc_id AND ua.u = c.a
          LEFT JOIN uni ut ON ut.doc_id = c.doc_id AND ut.u = c.t
          WHERE c.stop),
allc AS (SELECT doc_id, keyword, kf, log_f, addv FROM plain
         UNION ALL SELECT doc_id, keyword, kf, ln(2.0 - pp), pp - 1.0 FROM stops)
SELECT doc_id, keyword, kf, round(exp(sum(log_f)) / (kf * (1.0 + sum(addv))), 8) AS score FROM allc GROUP BY doc_id, keyword, kf"""
)


@register("text_keyword_candidates", _DUCK_CANDIDATES)
def q_text_keyword_candidates(spark: SparkSession, sf: str) -> DataFrame:
    c = kw.candidate_scores(_docs(spark, sf), "doc_id", "text")
    return c.select("doc_id", "keyword", "kf", F.round("score", 8).alias("score"))


# Letters beyond ASCII in ``documents``; the oracle's edit distance counts bytes, so each gets a capital letter (keywords are lower-case).
_LETTERS = "áéíóúüñàâçèêëîïôûùœäöß"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"[: len(_LETTERS)]


def _duck_keywords() -> str:
    """Up to ``TOP`` picks: after each, the candidates behind it that aren't similar to it are left."""
    plain = f"translate(keyword, '{_LETTERS}', '{_CAPITALS}')"
    head = _DUCK_CANDIDATES.replace("round(exp(sum(log_f)) / (kf * (1.0 + sum(addv))), 8)", f"round(exp(sum(log_f)) / (kf * (1.0 + sum(addv))), {kw.RANK_DIGITS})")
    before, last = head.rsplit("SELECT doc_id, keyword, kf, round(", 1)
    steps = [
        f"cand AS (SELECT doc_id, keyword, kf, round({last})",
        f"rest0 AS MATERIALIZED (SELECT doc_id, keyword, score, {plain} AS word, row_number() OVER (PARTITION BY doc_id ORDER BY score, keyword) AS n FROM cand)",
    ]
    for i in range(kw.TOP):
        steps.append(f"pick{i} AS MATERIALIZED (SELECT * FROM rest{i} JOIN (SELECT doc_id, min(n) AS n FROM rest{i} GROUP BY doc_id) USING (doc_id, n))")
        steps.append(
            f"""rest{i + 1} AS MATERIALIZED (SELECT r.doc_id, r.keyword, r.score, r.word, r.n FROM rest{i} r JOIN pick{i} p USING (doc_id)
  WHERE r.n > p.n AND 1.0 - levenshtein(r.word, p.word) / greatest(length(r.word), length(p.word), 1) <= {kw.DEDUP_LIM})"""
        )
    picks = "\nUNION ALL ".join(f"SELECT doc_id, {i} AS rank, keyword, score FROM pick{i}" for i in range(kw.TOP))
    return f"{before.rstrip()},\n" + ",\n".join(steps) + f",\npicks AS ({picks})"


@register("text_keywords", f"{_duck_keywords()} SELECT doc_id, CAST(rank AS INTEGER) AS rank, keyword, score FROM picks")
def q_text_keywords(spark: SparkSession, sf: str) -> DataFrame:
    return kw.keywords(_docs(spark, sf), "doc_id", "text")


@register(
    "prompt_keywords",
    f"""{_duck_keywords()} SELECT doc_id, '{prompts.KEYWORDS_PREFIX}' || string_agg(keyword, ', ' ORDER BY rank) AS suggestion
FROM picks WHERE rank < 3 GROUP BY doc_id""",
)
def q_prompt_keywords(spark: SparkSession, sf: str) -> DataFrame:
    return kw.prompts_of(_docs(spark, sf), "doc_id", "text")


_DUCK_TOPICS_TRUE = "TRUE AS known, TRUE AS ordered, TRUE AS weight_ok"


@register(
    "text_topics_checked",
    f"SELECT t AS topic_id, r AS rank, {_DUCK_TOPICS_TRUE} FROM (SELECT unnest(range(5)) AS t), (SELECT unnest(range(10)) AS r)",
)
def q_text_topics_checked(spark: SparkSession, sf: str) -> DataFrame:
    # what must hold for any topics: terms of the documents, once a topic, weights that fall and are shares
    docs = table(spark, sf, "documents")
    found = topics.describe_topics(docs, "doc_id", "text", k=5, terms=10, seed=7, max_iter=3)
    terms = topics.bag_of_words(docs, "doc_id", "text").select("term").distinct().withColumn("known", F.lit(True))
    by_rank, by_term = Window.partitionBy("topic_id").orderBy("rank"), Window.partitionBy("topic_id", "term")
    checked = found.join(terms, "term", "left").withColumn("before", F.lag("weight").over(by_rank)).withColumn("times", F.count("*").over(by_term))
    return checked.select(
        F.col("topic_id").cast("bigint").alias("topic_id"), F.col("rank").cast("bigint").alias("rank"), (F.coalesce("known", F.lit(False)) & (F.col("times") == 1)).alias("known"),
        F.coalesce(F.col("before") >= F.col("weight"), F.lit(True)).alias("ordered"), F.col("weight").between(0.0, 1.0).alias("weight_ok"),
    )
