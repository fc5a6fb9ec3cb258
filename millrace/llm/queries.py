"""Registered queries of the training-data operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm.ann import nearest
from millrace.llm.chat import PART_TURNS, render_chats
from millrace.llm.collocations import collocations
from millrace.llm.exact_dedup import exact_dedup
from millrace.llm.html_text import main_texts
from millrace.llm.language_id import held_out, predict_languages, train_dictionaries
from millrace.llm.lexical import K as TOP, LOWER, TERM, UPPER, ranked_search
from millrace.llm.line_dedup import drop_repeated_lines
from millrace.llm.mixing import DIMENSIONS, TOPICS, WORD, Targets, UNREACHED, sampling_table
from millrace.llm.packing import pack_documents
from millrace.llm.quality import score_quality
from millrace.llm.registry import ORACLES, QUERIES, query, table  # noqa: F401
from millrace.llm.simhash_vp import hex_fingerprint, near_duplicates
from millrace.llm.url_filter import judge_urls


@query("op3_exact_dedup", """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)""")
def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(table(spark, folder, "documents"))


@query("op5_chat_formatting", f"""
WITH b AS (SELECT conv_id, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) AS pos
           FROM (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
                 FROM conversations)),
h AS (SELECT *, md5(pos || ':' || length(role) || ':' || role || ':' || text) AS d FROM b),
p AS (SELECT *, sum(('0x' || substr(d, 1, 16))::UBIGINT::HUGEINT) OVER w AS h1,
             sum(('0x' || substr(d, 17, 16))::UBIGINT::HUGEINT) OVER w AS h2,
             count(*) OVER (PARTITION BY conv_id) AS n
      FROM h WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
longer AS (SELECT DISTINCT pos, h1, h2 FROM p WHERE pos < n),
kept AS (SELECT min(conv_id) AS conv_id, n AS turns, count(*) AS copies FROM p
         WHERE pos = n AND (pos, h1, h2) NOT IN (SELECT (pos, h1, h2) FROM longer) GROUP BY n, h1, h2)
SELECT p.conv_id, (pos - 1) // {PART_TURNS} AS part, turns, copies,
       string_agg('<|' || role || '|>' || chr(10) || text || chr(10) || '<|end|>' || chr(10), '' ORDER BY pos) AS rendered
FROM p JOIN kept ON p.conv_id IS NOT DISTINCT FROM kept.conv_id GROUP BY ALL""")
def op5_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    return render_chats(table(spark, folder, "conversations"))


def _mixing_sql(rounds: int = 12) -> str:
    """The same fit and the same sizing, one window per rescaling, written out."""
    hits = ", ".join(" + ".join(f"(strlen(t) - strlen(replace(t, '{m}', ''))) // {len(m.encode())}" for m in marks)
                     + f" AS h{i}" for i, marks in enumerate(TOPICS.values()))
    best = "greatest(" + ", ".join(f"h{i}" for i in range(len(TOPICS))) + ")"
    topic = "CASE WHEN " + best + " = 0 THEN 'general' " + " ".join(
        f"WHEN h{i} = {best} THEN '{n}'" for i, n in enumerate(TOPICS)) + " END"
    power = Targets().exponents
    steps, last = [], "fit"
    for r in range(rounds):
        for d in DIMENSIONS:
            steps.append(f"w_{r}_{d} AS MATERIALIZED (SELECT * REPLACE (coalesce(round(weight * t_{d} * n_all / nullif("
                         f"sum(weight) OVER (PARTITION BY {d}), 0), 6), 0) AS weight) FROM {last})")
            last = f"w_{r}_{d}"
    fitted, last = last, "wanted"
    for r in range(rounds):
        for d in DIMENSIONS:
            lift = f"sum(want) OVER (PARTITION BY {d}) / nullif(sum(least(open, tokens::DOUBLE)) OVER (PARTITION BY {d}), 0)"
            steps.append(f"o_{r}_{d} AS MATERIALIZED (SELECT * REPLACE (least(coalesce(round(open * ({lift}), 6), 0), "
                         f"tokens * 1e6::DOUBLE) AS open) FROM {last})")
            last = f"o_{r}_{d}"
    sizing = f"""
first_cells AS (SELECT *, sum(tokens) OVER cells AS there, sum(weight) OVER cells - {UNREACHED}::DOUBLE * n_all AS spare
                FROM {fitted} WINDOW cells AS (ORDER BY weight / tokens DESC, {", ".join(DIMENSIONS)}
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
sized AS (SELECT *, least(min(CASE WHEN spare > 0 THEN there / spare END) OVER (), 1.0::DOUBLE) AS scale FROM first_cells),
wanted AS MATERIALIZED (SELECT *, round(weight * scale, 6) AS want, round(weight * scale, 6) AS open FROM sized)"""
    steps.insert(rounds * len(DIMENSIONS), sizing)
    natural = ", ".join(f"sum(tokens) OVER (PARTITION BY {d})::DOUBLE AS n_{d}" for d in DIMENSIONS)
    raw = ", ".join(f"pow(n_{d} / n_all, {power[d]}) AS r_{d}" for d in DIMENSIONS)
    scaled = ", ".join(f"round(r_{d} / sum(r_{d} * tokens / n_{d}) OVER (), 12) AS t_{d}" for d in DIMENSIONS)
    return f"""
WITH d AS (SELECT doc_id, coalesce(source, 'unknown') AS source, coalesce(lang, 'unknown') AS lang,
                  coalesce(text, '') AS t FROM documents),
h AS (SELECT *, {hits} FROM d),
m AS MATERIALIZED (SELECT doc_id, t, source, lang, {topic} AS topic,
       len(regexp_extract_all(t, '{WORD}')) AS tokens FROM h),
c AS (SELECT source, lang, topic, sum(tokens)::BIGINT AS tokens FROM m GROUP BY ALL HAVING sum(tokens) > 0),
n AS (SELECT *, sum(tokens) OVER ()::BIGINT AS n_all, {natural} FROM c),
s AS (SELECT *, {raw} FROM n),
fit AS MATERIALIZED (SELECT *, {scaled}, tokens::DOUBLE AS weight FROM s),
{", ".join(steps)},
p AS (SELECT source, lang, topic, round(least(open, tokens::DOUBLE) / tokens, 9) AS chance FROM {last}),
o AS (SELECT doc_id, t, source, lang, topic, tokens,
             CASE WHEN tokens = 0 THEN 1.0 ELSE coalesce(chance, 0.0) END::DOUBLE AS probability
      FROM m LEFT JOIN p USING (source, lang, topic))
SELECT doc_id, source, lang, topic, tokens, probability,
       ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, t)), 1, 8))::UBIGINT / 4294967296.0 < probability AS kept
FROM o"""


@query("op1_mixing", _mixing_sql())
def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return sampling_table(table(spark, folder, "documents")).select(
        "doc.doc_id", *DIMENSIONS, "tokens", "probability", "kept")


@query("op6_url_filter")
def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(table(spark, folder, "pages"))


@query("op9_simhash_near_dedup")
def op9_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents")).select(
        "doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


@query("op10_language_id")
def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return predict_languages(docs, train_dictionaries(docs)).select(
        "doc.doc_id", held_out(F.col("doc.doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


@query("op7_quality_classifier")
def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op4_packing")
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = pack_documents(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("length"),
                         F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op2_nearest_neighbours")
def op2_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    found = nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query("op8_line_dedup")
def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return drop_repeated_lines(table(spark, folder, "documents")).select("doc.doc_id", "lines", "dropped", "text")


@query("op13_lexical_search", f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}') AS t FROM documents),
s AS (SELECT count(*)::BIGINT AS n_docs, sum(len(t))::BIGINT AS n_terms FROM d WHERE len(t) > 0),
tf AS (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM d),
c AS (SELECT r, doc_id, n, term, count(*) AS tf FROM tf GROUP BY ALL),
q AS (SELECT item_id, unnest(list_distinct(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
             '{TERM}'))) AS term FROM benchmark),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
      FROM (SELECT term, count(*) AS df FROM c WHERE term IN (SELECT term FROM q) GROUP BY term), s),
p AS (SELECT r, doc_id, term,
             (1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms)) AS part FROM c, s),
h AS (SELECT item_id, r, doc_id, sum(w * part)::BIGINT AS score FROM q JOIN w USING (term) JOIN p USING (term) GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM h WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= {TOP}""")
def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op11_collocations", r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM t),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
o AS (SELECT lang, unnest([w[i:i], CASE WHEN i < len(w) THEN w[i:i + 1] END, CASE WHEN i + 1 < len(w) THEN w[i:i + 2] END]) AS g
      FROM g),
f AS MATERIALIZED (SELECT lang, g, count(*)::HUGEINT AS f FROM o WHERE g IS NOT NULL GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE len(g) = 1 GROUP BY lang),
c AS (SELECT lang, g, f AS a, unnest(range(1, len(g))) AS k FROM f WHERE len(g) > 1 AND f >= 10),
s AS (SELECT c.lang, c.g, c.a, c.k, x.f AS l, y.f AS r, (1000000 * c.a * c.a) // (x.f * y.f) AS score
      FROM c JOIN f x ON x.lang = c.lang AND x.g = c.g[1:c.k] JOIN f y ON y.lang = c.lang AND y.g = c.g[c.k + 1:]),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
x AS (SELECT lang, a, unnest([g[1:2], g[2:3]]) AS g FROM b WHERE len(g) = 3),
kept AS (SELECT * FROM b WHERE NOT EXISTS (
           SELECT 1 FROM x WHERE x.lang = b.lang AND x.g = b.g AND len(b.g) = 2 AND 100 * x.a >= 50 * b.a)),
ranked AS (SELECT *, array_to_string(g, ' ') AS phrase FROM kept),
best AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM ranked)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM best JOIN n USING (lang) WHERE rank <= 2000""")
def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


@query("op12_html_extraction")
def op12_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return main_texts(table(spark, folder, "pages"))
