"""Chunking and search over ``documents``, ``embeddings`` and ``benchmark``."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import text as tx
from millrace.functions.vectors import cosine
from millrace.operators import chunking as ch, search as se, segmentation as sg
from millrace.operators.postings import PostingIndex
from millrace.operators.relational import checked_broadcast
from millrace.operators.versioned import upsert_by_key
from millrace.plans.registry import query
from millrace.session import scratch_dir, stage_table
from millrace.sources.tables import spread, table


def _documents(spark, d):
    return spread(table(spark, d, "documents"))


TRIM = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"


@query("sentence_split", f"""
SELECT doc_id, CAST(pos - 1 AS INTEGER) AS pos, sentence FROM (
  SELECT doc_id, unnest(s) AS sentence, generate_subscripts(s, 1) AS pos FROM (
    SELECT doc_id, list_filter(list_transform(string_split_regex(text, '[。.]'), lambda x: {TRIM.format('x')}), lambda x: x <> '') AS s
    FROM documents))""")
def sentence_split(spark, d):
    return ch.sentence_split(_documents(spark, d).select("doc_id", "text"), "text")


@query("token_estimate", "SELECT doc_id, CAST(greatest(5, ceil(length(text) / 4.0)) AS BIGINT) AS tokens FROM documents")
def token_estimate(spark, d):
    return _documents(spark, d).select("doc_id", tx.token_estimate("text").alias("tokens"))


@query("fixed_chunk", """
WITH p AS (SELECT doc_id, source, text, CASE WHEN length(text) <= 200 THEN 1 ELSE CAST(ceil((length(text) - 20) / 180.0) AS BIGINT) END AS n
           FROM documents WHERE length(text) > 0),
c AS (SELECT doc_id, source, text, unnest(range(0, n)) AS i FROM p)
SELECT doc_id, source, printf('chunk_%03d', i + 1) AS chunk_id, substring(text, CAST(i * 180 + 1 AS BIGINT), 200) AS content FROM c""")
def fixed_chunk(spark, d):
    return ch.fixed_chunk(_documents(spark, d).select("doc_id", "text", "source"), "text", "source")


@query("chunk_id", "SELECT doc_id, md5(source || lang || text) AS chunk_id FROM documents")
def chunk_id(spark, d):
    return _documents(spark, d).select("doc_id", tx.chunk_id("source", "lang", "text").alias("chunk_id"))


STOP_SQL = ", ".join(f"'{w}'" for w in tx.STOP_WORDS)
TOKENS_SQL = f"list_filter(regexp_extract_all(lower(text), '{tx.WORD}'), lambda w: w NOT IN ({STOP_SQL}))"


@query("tokenize", f"SELECT doc_id, coalesce(array_to_string({TOKENS_SQL}, ' '), '') AS content_tokenized FROM documents")
def tokenize(spark, d):
    return _documents(spark, d).select("doc_id", tx.tokenize("text").alias("content_tokenized"))


def bm25_sql(top: int, docs: str = "documents") -> str:
    return f"""
docs AS (SELECT doc_id, {TOKENS_SQL} AS tokens FROM {docs}),
size AS (SELECT count(*) AS n, avg(len(tokens)) AS a FROM docs),
words AS (SELECT doc_id, len(tokens) AS dl, unnest(tokens) AS term FROM docs),
asked AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({TOKENS_SQL}) AS term FROM benchmark)),
tf AS (SELECT doc_id, dl, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
hit AS (
  SELECT item_id, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / a))), 9) AS score
  FROM asked JOIN tf USING (term) JOIN df USING (term), size GROUP BY item_id, doc_id),
by_word AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM hit
            QUALIFY rank <= {top})
"""


def _asked(spark, d):
    return table(spark, d, "benchmark").select("item_id", tx.tokens("text").alias("terms"))


@query("bm25_search", f"WITH {bm25_sql(10)} SELECT item_id, doc_id, round(score, 6) AS score, rank FROM by_word")
def bm25_search(spark, d):
    docs = _documents(spark, d).select("doc_id", tx.tokens("text").alias("tokens"))
    out = se.bm25_search(docs, _asked(spark, d), "doc_id", "tokens", "item_id", "terms", 10)
    return out.select("item_id", "doc_id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@query("recursive_chunk", """
SELECT doc_id, length(text) AS text_chars, md5(text) AS rebuilt_md5, true AS within_size FROM documents""")
def recursive_chunk(spark, d):
    """Pieces of every document, put together again without the overlaps: nothing lost, none too long."""
    pieces = _documents(spark, d).select("doc_id", ch.recursive_chunks("text").alias("p"))
    rebuilt = F.aggregate("p", F.lit(""), lambda acc, p: F.concat(
        acc, p["content"].substr(F.length(acc) - p["start"] + 1, F.length(p["content"]))))
    within = F.forall("p", lambda p: F.length(p["content"]) <= ch.RECURSIVE_SIZE)
    return pieces.select("doc_id", rebuilt.alias("t"), within.alias("within_size")).select(
        "doc_id", F.length("t").cast("long").alias("text_chars"), F.md5("t").alias("rebuilt_md5"), "within_size")


# Word counts in 32 hashed slots stand in for a model's vectors: whole numbers, so both engines agree exactly.
SLOTS = 32


def counts_sql(name: str, source: str, key: str, prefix: str) -> str:
    """A table ``name(key, v)`` of the stand-in vectors of ``source(key, text)``."""
    return f"""
{name}_words AS (SELECT {key}, unnest(string_split_regex('{prefix}' || lower(coalesce(text, '')), '\\s+')) AS word FROM {source}),
{name}_slots AS (SELECT {key}, CAST('0x' || md5(word)[1:8] AS UBIGINT) % {SLOTS} AS slot, count(*) AS n FROM {name}_words
                 WHERE word <> '' GROUP BY ALL),
{name} AS (SELECT {key}, list(coalesce(n, 0)::DOUBLE ORDER BY slot) AS v
           FROM (SELECT DISTINCT {key} FROM {name}_slots) CROSS JOIN (SELECT unnest(range({SLOTS})) AS slot)
           LEFT JOIN {name}_slots USING ({key}, slot) GROUP BY {key})
"""


def _counted(df, text, name, is_query=False):
    return ch.embed_rows(df, text, ch.hashed_bag_encoder(SLOTS, unit=False), name, is_query)


SEMANTIC_SQL = f"""
u AS (SELECT doc_id, list_filter(list_transform(string_split_regex(text, '[。.]'), lambda x: {TRIM.format('x')}), lambda x: x <> '') AS s
      FROM documents),
t AS (SELECT doc_id, unnest(s) AS text, generate_subscripts(s, 1) AS pos FROM u),
k AS (SELECT *, doc_id || '-' || pos AS sid FROM t), {counts_sql('vec', 'k', 'sid', 'passage: ')},
b AS (SELECT doc_id, pos, text AS sentence, v, lag(v) OVER w AS pv, count(*) OVER (PARTITION BY doc_id) AS n
      FROM k JOIN vec USING (sid) WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
m AS (SELECT *, CASE WHEN pv IS NOT NULL AND list_cosine_similarity(pv, v) >= 0.5237 THEN 0 ELSE 1 END AS cut FROM b),
c AS (SELECT *, sum(cut) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS chunk_index FROM m)
"""


@query("semantic_chunk", f"""WITH {SEMANTIC_SQL}
SELECT doc_id, CAST(chunk_index AS BIGINT) AS chunk_index, CAST(count(*) AS INTEGER) AS sentence_count,
       string_agg(sentence, '. ' ORDER BY pos) || CASE WHEN max(n) = 1 THEN '' ELSE '.' END AS content
FROM c GROUP BY doc_id, chunk_index""")
def semantic_chunk(spark, d):
    """Sentences of every document, embedded and kept together while they are alike."""
    sentences = ch.sentence_split(_documents(spark, d).select("doc_id", "text"), "text")
    rows = stage_table(_counted(sentences.select("doc_id", "pos", "sentence"), "sentence", "vector"), "sentences")
    return ch.semantic_chunk(rows, "doc_id", "pos", "sentence", "vector", floor=0.5237)


# The queries are the mean vectors of the labels, drawn from the whole table.
CENTROID_SQL = """
dims AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
means AS (SELECT label, i, avg(x) AS x FROM dims GROUP BY label, i),
probes AS (SELECT label, list(x ORDER BY i) AS q FROM means GROUP BY label)
"""


def _probes(spark, d):
    dims = table(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    means = dims.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("i", "x")))
    return means.groupBy("label").agg(F.transform(ordered, lambda p: p["x"]).alias("q"))


@query("cosine_similarity", f"""WITH {CENTROID_SQL}
SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], q), 9) AS similarity FROM embeddings JOIN probes USING (label)""")
def cosine_similarity(spark, d):
    rows = table(spark, d, "embeddings").join(checked_broadcast(_probes(spark, d)), "label")
    return rows.select("vec_id", F.round(cosine("embedding", "q"), 9).alias("similarity"))


def topk_sql(k: int, metric: str = "cosine") -> str:
    score = ("list_cosine_similarity(embedding::DOUBLE[], q)" if metric == "cosine"
             else "-(list_distance(embedding::DOUBLE[], q) ** 2)")
    return f"""
exact AS (SELECT p.label, vec_id, round({score}, 9) AS score,
                 row_number() OVER (PARTITION BY p.label ORDER BY round({score}, 9) DESC, vec_id) AS rank
          FROM embeddings, probes p QUALIFY rank <= {k})
"""


def _ranked(df):
    return df.withColumn("rank", F.col("rank").cast("long")).withColumn("score", F.round("score", 6))


@query("vector_topk", f"WITH {CENTROID_SQL}, {topk_sql(10)} SELECT label, vec_id, round(score, 6) AS score, rank FROM exact")
def vector_topk(spark, d):
    return _ranked(se.vector_topk(table(spark, d, "embeddings"), _probes(spark, d), "vec_id", "embedding", "label", "q", 10))


@query("vector_topk_l2", f"WITH {CENTROID_SQL}, {topk_sql(10, 'l2')} SELECT label, vec_id, round(score, 6) AS score, rank FROM exact")
def vector_topk_l2(spark, d):
    return _ranked(se.vector_topk(table(spark, d, "embeddings"), _probes(spark, d), "vec_id", "embedding", "label", "q",
                                  10, metric="l2"))


@query("ann_ivf_search")
def ann_ivf_search(spark, d):
    """A search through 14 of 16 cells: its hits, their exact scores, and the recall of each label.

    What a search through some cells finds hangs on the clustering, which no SQL repeats: the rows are tested
    against brute force, and ``ann_ivf_all_cells`` has its SQL.
    """
    base, probes = table(spark, d, "embeddings"), _probes(spark, d)
    index = se.CellIndex.build(base, "vec_id", "embedding", cells=16)
    near = stage_table(index.search(probes, "label", "q", 10, nprobe=14), "near")
    exact = se.vector_topk(base, probes, "vec_id", "embedding", "label", "q", 10)
    found = exact.select("label", "vec_id").join(near, ["label", "vec_id"], "left")
    recall = found.groupBy("label").agg(F.avg(F.col("rank").isNotNull().cast("double")).alias("recall"))
    return _ranked(near).join(checked_broadcast(recall), "label").select("label", "rank", "vec_id", "score", "recall")


@query("ann_ivf_all_cells", f"WITH {CENTROID_SQL}, {topk_sql(10)} SELECT label, vec_id, round(score, 6) AS score, rank FROM exact")
def ann_ivf_all_cells(spark, d):
    """Through all cells the index gives the exact answer."""
    index = se.CellIndex.build(table(spark, d, "embeddings"), "vec_id", "embedding", cells=16)
    return _ranked(index.search(_probes(spark, d), "label", "q", 10, nprobe=16))


# Every document and every question, with the stand-in vectors of their texts.
HYBRID_SQL = f"""
{counts_sql('doc_vec', 'documents', 'doc_id', 'passage: ')}, {counts_sql('item_vec', 'benchmark', 'item_id', 'query: ')},
corpus AS (SELECT doc_id, text, v FROM documents JOIN doc_vec USING (doc_id)),
questions AS (SELECT item_id, v AS q FROM item_vec),
near AS (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY round(list_cosine_similarity(v, q), 9) DESC, doc_id) AS rank
         FROM corpus, questions QUALIFY rank <= 50),
{bm25_sql(50, 'corpus')},
lists AS (SELECT item_id, doc_id, 0 AS s, rank FROM near UNION ALL SELECT item_id, doc_id, 1, rank FROM by_word),
fused AS (SELECT item_id, doc_id, round(sum(1.0::DOUBLE / (60 + rank)), 12) AS rrf_score, min(s) AS s, arg_min(rank, s) AS r FROM lists GROUP BY ALL)
"""


def _searchable(spark, d):
    """Tokens and vectors of all documents and questions, encoded once."""
    docs = _counted(_documents(spark, d).select("doc_id", "text"), "text", "embedding")
    asked = _counted(table(spark, d, "benchmark").select("item_id", "text"), "text", "q", is_query=True)
    return (stage_table(docs.select("doc_id", tx.tokens("text").alias("tokens"), "embedding"), "chunks"),
            stage_table(asked.select("item_id", tx.tokens("text").alias("terms"), "q"), "questions"))


@query("rrf_fuse", f"WITH {HYBRID_SQL} SELECT item_id, doc_id, round(rrf_score, 9) AS rrf_score, s AS first_system, CAST(r - 1 AS INTEGER) AS first_position FROM fused")
def rrf_fuse(spark, d):
    chunks, asked = _searchable(spark, d)
    lists = (se.vector_topk(chunks, asked, "doc_id", "embedding", "item_id", "q", 50),
             se.bm25_search(chunks, asked, "doc_id", "tokens", "item_id", "terms", 50))
    both = [f.select("item_id", "doc_id", F.lit(i).alias("system"), (F.col("rank") - 1).alias("position"))
            for i, f in enumerate(lists)]
    out = se.rrf_fuse(both[0].unionByName(both[1]), "doc_id", by=["item_id"])
    return out.withColumn("rrf_score", F.round("rrf_score", 9))


FINAL_SQL = HYBRID_SQL + """,
short AS (SELECT * FROM fused QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY rrf_score DESC, s, r) <= 50),
final AS (SELECT item_id, doc_id, rrf_score, round(list_cosine_similarity(v, q), 9) AS rerank_score,
                 row_number() OVER (PARTITION BY item_id ORDER BY round(list_cosine_similarity(v, q), 9) DESC, doc_id) AS rank
          FROM short JOIN corpus USING (doc_id) JOIN questions USING (item_id) QUALIFY rank <= 5)
"""


def _hybrid(spark, d):
    chunks, asked = _searchable(spark, d)
    return chunks, asked, se.hybrid_search(chunks, asked, "doc_id", "embedding", "tokens", "item_id", "q", "terms", 5)


@query("hybrid_search", f"""WITH {FINAL_SQL}
SELECT item_id, doc_id, round(rrf_score, 9) AS _rrf_score, round(rerank_score, 6) AS _rerank_score, rank FROM final""")
def hybrid_search(spark, d):
    out = _hybrid(spark, d)[2]
    return out.select("item_id", "doc_id", F.round("_rrf_score", 9).alias("_rrf_score"),
                      F.round("_rerank_score", 6).alias("_rerank_score"), F.col("rank").cast("long").alias("rank"))


@query("rank_compare", f"""WITH {FINAL_SQL},
places AS (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY round(list_cosine_similarity(v, q), 9) DESC, doc_id) AS place
           FROM corpus, questions)
SELECT item_id, doc_id, CASE WHEN place <= 500 THEN CAST(place AS VARCHAR) ELSE '>500' END AS exact_rank
FROM by_word JOIN places USING (item_id, doc_id) WHERE rank <= 50""")
def rank_compare(spark, d):
    """Where the keyword hits stand in the exact vector ranking."""
    chunks, asked = _searchable(spark, d)
    hits = se.bm25_search(chunks, asked, "doc_id", "tokens", "item_id", "terms", 50)
    exact = se.vector_topk(chunks, asked, "doc_id", "embedding", "item_id", "q", 500)
    return se.rank_compare(hits, exact, "item_id", "doc_id").select("item_id", "doc_id", "exact_rank")


@query("candidate_pool", f"""WITH {FINAL_SQL},
heads AS (SELECT item_id, doc_id, 0 AS l, rank FROM near WHERE rank <= 3 UNION ALL
          SELECT item_id, doc_id, 1, rank FROM by_word WHERE rank <= 3
          UNION ALL SELECT item_id, doc_id, 2, rank FROM final WHERE rank <= 3)
SELECT item_id, doc_id, min(l) AS list, arg_min(rank, l) AS rank FROM heads GROUP BY item_id, doc_id""")
def candidate_pool(spark, d):
    chunks, asked, final = _hybrid(spark, d)
    near = se.vector_topk(chunks, asked, "doc_id", "embedding", "item_id", "q", 3)
    words = se.bm25_search(chunks, asked, "doc_id", "tokens", "item_id", "terms", 3)
    pool = se.candidate_pool([near, words, final], "item_id", "doc_id")
    return pool.withColumn("rank", F.col("rank").cast("long"))


@query("embed_rows", r"""
WITH w AS (SELECT doc_id, unnest(string_split_regex('passage: ' || lower(text), '\s+')) AS word FROM documents),
s AS (SELECT doc_id, CAST('0x' || md5(word)[1:8] AS UBIGINT) % 64 AS slot, count(*) AS n FROM w WHERE word <> '' GROUP BY ALL),
z AS (SELECT doc_id, sqrt(sum(n * n)) AS size FROM s GROUP BY doc_id)
SELECT doc_id, CAST(slot AS INTEGER) AS slot, CAST(floor(n / size * 100 + 0.317) AS BIGINT) AS weight FROM s JOIN z USING (doc_id)""")
def embed_rows(spark, d):
    """The non-zero parts of every document's vector from the stand-in encoder, in hundredths.

    The vectors are doubles: in single precision a part near a cut falls on the wrong side of it.
    """
    rows = ch.embed_rows(_documents(spark, d).select("doc_id", "text"), "text", ch.hashed_bag_encoder(64, double=True),
                         double=True)
    parts = rows.select("doc_id", F.posexplode("vector").alias("slot", "x")).where(F.col("x") != 0)
    return parts.select("doc_id", "slot", F.floor(F.col("x") * 100 + 0.317).alias("weight"))


@query("rag_build", """
SELECT lang AS meeting_name, count(*) FILTER (length(text) > 0) AS speeches, 0::BIGINT AS added_by_rerun, true AS within_size
FROM documents GROUP BY lang""")
def rag_build(spark, d):
    """Documents to speeches to chunks with ids, tokens and vectors; the second run changes nothing."""
    speeches = _documents(spark, d).select(
        F.concat(F.lit("M"), "doc_id").alias("issue_id"), F.concat(F.lit("M"), "doc_id", F.lit("-1")).alias("speech_id"),
        F.col("source").alias("speaker"), F.lit("2026-03-12").alias("date"), F.col("lang").alias("name_of_meeting"),
        F.col("text").alias("speech"))
    root = scratch_dir(spark, "chunks")
    built = ch.build_chunks(speeches, ch.hashed_bag_encoder(64))
    built.write.parquet(f"{root}/1")
    first = spark.read.parquet(f"{root}/1")
    upsert_by_key(first, built, ["chunk_id"]).write.parquet(f"{root}/2")
    second = spark.read.parquet(f"{root}/2")
    built_by = first.groupBy("meeting_name").agg(
        F.count_distinct("speech_id").alias("speeches"), F.count(F.lit(1)).alias("_n"),
        F.max(F.length("content")).alias("_longest"))
    again = second.groupBy("meeting_name").agg(F.count(F.lit(1)).alias("_m"))
    return built_by.join(again, "meeting_name").select(
        "meeting_name", "speeches", (F.col("_m") - F.col("_n")).alias("added_by_rerun"),
        (F.col("_longest") <= ch.RECURSIVE_SIZE).alias("within_size"))


COMPOUND = 8  # words longer than this are cut


@query("segment_words", rf"""
WITH RECURSIVE w AS (SELECT unnest(regexp_extract_all(lower(text), '{tx.WORD}')) AS w FROM documents),
c AS (SELECT w, count(*) AS n FROM w WHERE length(w) <= {COMPOUND} GROUP BY w HAVING count(*) >= 10
      ORDER BY count(*) * length(w) DESC, w LIMIT {sg.SIZE}),
m AS (SELECT w, CAST(floor({sg.SCALE} * ln(t / n)) AS BIGINT) AS cost FROM c, (SELECT CAST(sum(n) AS DOUBLE) AS t FROM c)),
r AS (SELECT DISTINCT w AS run FROM w WHERE length(w) > {COMPOUND}),
ends AS (SELECT run, unnest(range(1, length(run) + 1)) AS e FROM r),
parts AS (SELECT run, e, unnest(range(1, least({COMPOUND}, e) + 1)) AS k FROM ends),
priced AS (SELECT run, e, k, coalesce(cost, CASE WHEN k = 1 THEN (SELECT max(cost) + {10 * sg.SCALE} FROM m) END) AS cost
           FROM parts LEFT JOIN m ON m.w = substr(run, e - k + 1, k)),
step AS (SELECT run, e, list({{'k': k, 'cost': cost}}) AS options FROM priced WHERE cost IS NOT NULL GROUP BY run, e),
path AS (SELECT run, 0::BIGINT AS e, [{{'cost': 0::BIGINT, 'words': 0::BIGINT, 'size': 0::BIGINT, 'path': ''}}] AS best FROM r
  UNION ALL
  SELECT p.run, p.e + 1, list_prepend(list_sort(list_transform(options, lambda o: {{
      'cost': p.best[o.k].cost + o.cost, 'words': p.best[o.k].words + 1, 'size': -o.k,
      'path': p.best[o.k].path || ' ' || substr(p.run, p.e + 2 - o.k, o.k)}}))[1], p.best)[1:{COMPOUND}]
  FROM path p JOIN step s ON s.run = p.run AND s.e = p.e + 1)
SELECT run, best[1].path[2:] AS words, best[1].cost AS cost FROM path WHERE e = length(run)""")
def segment_words(spark, d):
    """Long words cut along the cheapest path of shorter ones, whose costs are their rarity in the corpus."""
    words = _documents(spark, d).select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(tx.WORD), 0)).alias("word"))
    counted = stage_table(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "words")
    short = counted.where((F.length("word") <= COMPOUND) & (F.col("n") >= 10)).orderBy(
        (F.col("n") * F.length("word")).desc(), "word").limit(sg.SIZE)
    model = sg.WordModel.of_counts({r["word"]: r["n"] for r in short.toLocalIterator()})
    runs = counted.where(F.length("word") > COMPOUND).select(F.col("word").alias("run"))
    return sg.cut_runs(runs, "run", model).select("run", F.array_join("words", " ").alias("words"), "cost")


@query("bm25_stored", f"""WITH {bm25_sql(10)}
SELECT item_id, doc_id, round(score, 6) AS score, rank FROM by_word""")
def bm25_stored(spark, d):
    """The full keyword search from an index that is built once; the questions are asked in two calls."""
    docs = _documents(spark, d).select("doc_id", tx.tokens("text").alias("tokens"))
    index = PostingIndex.build(docs, "doc_id", "tokens", scratch_dir(spark, "index"))
    asked = _asked(spark, d)
    halves = [index.search(asked.where(F.col("item_id") % 2 == i), "item_id", "terms", 10, "doc_id") for i in (0, 1)]
    return _ranked(halves[0].union(halves[1]))
