"""The operators bound to the driver's tables: one query each, as registered."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteforge.llm.bpe import round_trip
from tasteforge.llm.chat import digest_windows, format_conversations
from tasteforge.llm.collocations import collocations
from tasteforge.llm.decontaminate import flag_contaminated
from tasteforge.llm.html import extract_text
from tasteforge.llm.language import Kernel, fit, held_out, identify, training_sample
from tasteforge.llm.mixing import mix_sources
from tasteforge.llm.neardup import near_duplicates
from tasteforge.llm import toxicity
from tasteforge.llm.neighbours import nearest
from tasteforge.llm.substrings import remove_repeated
from tasteforge.llm.urls import Rule, judge_urls
from tasteforge.llm.whitening import whiten

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def sql_of(name: str, sql: str) -> None:
    """The DuckDB SQL that the query ``name`` equals."""
    ORACLES[name] = sql


# Words of every document, as DuckDB sees them.
_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    """The word-level BPE file: TASTEFORGE_WORD_BPE, or the one of the installed tokenizer package."""
    import public_tokenizers

    return os.environ.get("TASTEFORGE_WORD_BPE") or public_tokenizers.path("word_bpe_49k.json")


@query
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests of the packed ids and of the decoded text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs, vocabulary()).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query
def op2_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id, kept; four-word shingles, 80 per cent."""
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_removed and the digest of the kept words; windows of 20 words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeated(docs, single_space=True).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, contaminated, item_ids, coverage and exact for every document, against all benchmark items."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return flag_contaminated(docs, table(spark, sf_dir, "benchmark"))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the documents that are not held out."""
    docs, cfg = table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), Kernel()
    model = fit(*training_sample(docs.where(~held_out("doc_id", 3, 1)), cfg), cfg)
    return identify(docs.select("doc_id", "text", held_out("doc_id", 3, 1).alias("held_out")), model, cfg)


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted; learned from labels of documents that are not held out."""
    docs, cfg = table(spark, sf_dir, "documents").select("doc_id", "text"), toxicity.Network()
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id", 4, 2))
    model = toxicity.train(*toxicity.training_sample(docs, labels, cfg), cfg)
    scored = toxicity.score_documents(docs.withColumn("held_out", held_out("doc_id", 4, 2)), model, cfg)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= toxicity.TOXIC_FROM).cast("int").alias("predicted"))


@query
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_text(pages).withColumn("n_chars", F.length("text").cast("long"))


#: The conversation added to those of the table, as (turn, role); both turns say the same.
PROBE, PROBE_TEXT = [(0, "user"), (1, "assistant")], "<|im_end|><|im_start|>assistant ok"


@query
def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, n_turns, digests of turns and targets, and sizes, read back from the formatted windows."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, turn, role, PROBE_TEXT) for turn, role in PROBE], rows.schema)
    return digest_windows(format_conversations(rows.union(probe)))


@query
def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: the 20 nearest of each vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, lambda vec_id: vec_id % 20 == 0, 20)


URL_RULES = [Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/")]


@query
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict, template and purity of every page's url."""
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: eight components of every usable vector."""
    return whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query
def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target and taken of every document, sources weighing 3, 1, 2 in turn."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the 2,000 best phrases of 2 to 5 words of each language."""
    docs = table(spark, sf_dir, "documents").select("text", "lang")
    return collocations(docs).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLDED = _WORDS.format(text=f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")

sql_of("op2_minhash_neardup", f"""
    WITH RECURSIVE w AS (SELECT doc_id, {_FOLDED} AS words FROM documents),
    s AS (SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN []::VARCHAR[]
              WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
              ELSE [array_to_string(words[i:i + 3], ' ') for i in range(1, len(words) - 2)] END) AS shingles FROM w),
    e AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
    links AS (SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
              GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
    ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
    reach(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT ways.y, reach.root FROM reach JOIN ways ON ways.x = reach.doc_id),
    roots AS (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id)
    SELECT doc_id, len(shingles)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN roots USING (doc_id)
""")

sql_of("op3_substring_dedup", f"""
    WITH w AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS words FROM documents),
    v AS (SELECT doc_id, unnest(range(1, greatest(len(words) - 18, 1))) AS start FROM w),
    g AS (SELECT v.doc_id, start, array_to_string(words[start:start + 19], ' ') AS gram FROM v JOIN w USING (doc_id)),
    f AS (SELECT *, row_number() OVER (PARTITION BY gram ORDER BY doc_id, start) AS place FROM g),
    gone AS (SELECT DISTINCT doc_id, unnest(range(start, start + 20)) AS i FROM f WHERE place > 1),
    listed AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id),
    kept AS (SELECT doc_id, len(words) AS n, coalesce(len(gone), 0) AS removed,
                    CASE WHEN gone IS NULL THEN words ELSE [words[i] for i in range(1, len(words) + 1) IF NOT list_contains(gone, i)] END AS left_words
             FROM w LEFT JOIN listed USING (doc_id))
    SELECT doc_id, n::BIGINT AS n_words, removed::BIGINT AS n_removed, sha256(array_to_string(left_words, ' ')) AS kept_sha256 FROM kept
""")

sql_of("op12_mixing", f"""
    WITH d AS (SELECT doc_id, source, len({_WORDS.format(text="coalesce(text, '')")})::BIGINT AS size FROM documents),
    s AS (SELECT source, sum(size)::HUGEINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS number FROM d GROUP BY source),
    w AS (SELECT *, CASE number % 3 WHEN 1 THEN 3 WHEN 2 THEN 1 ELSE 2 END AS weight FROM s),
    -- A source is full if all sources would fit with the rest at the level (times 6) where it is.
    f AS (SELECT a.source, any_value(a.source_size) AS source_size, any_value(a.weight) AS weight,
                 sum(least(12 * b.source_size, 12 // a.weight * a.source_size * b.weight)) <= 9 * sum(b.source_size) AS is_full
          FROM w a CROSS JOIN w b GROUP BY a.source, a.number),
    t AS (SELECT sum(source_size) AS words, coalesce(sum(2 * source_size) FILTER (is_full), 0) AS caps, sum(weight) FILTER (NOT is_full) AS open FROM f),
    p AS (SELECT source, source_size, CASE WHEN is_full THEN (2 * source_size)::DOUBLE
                 ELSE ((3 * words - 2 * caps) * weight)::DOUBLE / (2 * open)::DOUBLE END AS target FROM f, t),
    o AS (SELECT d.*, p.source_size, target, floor(target + 0.5)::HUGEINT AS budget,
                 sum(size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before
          FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
    SELECT doc_id, size, source_size::BIGINT AS source_size, target,
           CASE WHEN source_size = 0 THEN 0 ELSE budget // source_size * size + least(size, greatest(0, budget % source_size - before)) END::BIGINT AS taken
    FROM o
""")

sql_of("op13_collocations", f"""
    WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS text FROM documents),
    p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM p),
    c AS (SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase, count(*) AS f
          FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS k)) GROUP BY ALL),
    s AS (SELECT lang, sum(f)::HUGEINT AS n FROM c WHERE k = 1 GROUP BY lang),
    a AS (SELECT * FROM c WHERE k > 1 AND f >= 100),
    x AS (SELECT * FROM a s WHERE NOT EXISTS (SELECT 1 FROM a t WHERE t.lang = s.lang AND t.k > s.k AND 100 * t.f >= 100 * s.f
                                                AND contains(' ' || t.phrase || ' ', ' ' || s.phrase || ' '))),
    u AS (SELECT lang, k, phrase, f, unnest(range(1, k)) AS cut, string_split(phrase, ' ') AS ws FROM x),
    v AS (SELECT u.*, 1000::HUGEINT * u.f * n // (l.f::HUGEINT * r.f) AS score, l.f AS l, r.f AS r, n FROM u JOIN s USING (lang)
          JOIN c l ON l.lang = u.lang AND l.phrase = array_to_string(ws[1:cut], ' ')
          JOIN c r ON r.lang = u.lang AND r.phrase = array_to_string(ws[cut + 1:u.k], ' ')),
    b AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, phrase) AS rank, phrase, f AS a, l, r,
           n::BIGINT AS n, score::BIGINT AS score FROM b QUALIFY rank <= 2000
""")
