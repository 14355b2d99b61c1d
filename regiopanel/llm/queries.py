"""The operators of this folder applied to the test tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiopanel.llm import (bpe, embedding_dedup, exact_dedup, fill_middle, language_id, licenses, merkle, mixing, near_dedup,
                            packing, secrets, sharding, toxicity)
from regiopanel.llm.common import id_crc, prepare, table, written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return run
    return deco


@query("op1_exact_dedup", r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
r AS (SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size
      FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id))
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, text_sha256 FROM r""")
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as one batch into a new digest index."""
    index = exact_dedup.new_index(spark)
    found = exact_dedup.ingest(table(spark, sf_dir, "documents"), index)
    index.close()
    return found


@query("op4_near_dedup", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
             ELSE [array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n nx ON x = nx.doc_id JOIN n ny ON y = ny.doc_id WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(id, reached) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.id, e.y FROM r JOIN e ON r.reached = e.x),
m AS (SELECT id, min(reached) AS component_id FROM r GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d JOIN m ON d.doc_id = m.id LEFT JOIN n ON d.doc_id = n.doc_id""")
def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), near_dedup.Params(words=3, percent=85))


@query("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(language_id.learnable(docs))
    return language_id.predict(docs, model).withColumn("held_out", id_crc() % 4 == 2)


@query("op9_source_mix", mixing.oracle())
def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_mix(table(spark, sf_dir, "documents")).drop("times")


def multi_ranks() -> dict[bytes, int]:
    """Ranks of the public multilingual byte-level vocabulary (a file of the installed package)."""
    import public_tokenizers
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        return bpe.read_ranks(f.read())


@query("op10_byte_bpe")
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), multi_ranks())


@query("op3_embedding_dedup", """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
r(id, reached) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.id, l.y FROM r JOIN l ON r.reached = l.x),
m AS (SELECT id, min(reached) AS component_id FROM r GROUP BY 1),
n AS (SELECT x, count(*) AS n FROM l GROUP BY 1)
SELECT v.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, m.component_id, v.vec_id = m.component_id AS kept
FROM v JOIN m ON v.vec_id = m.id LEFT JOIN n ON v.vec_id = n.x""")
def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op6_kd_shards")
def op6_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = id_crc() % 5 == 0
    model = toxicity.fit(docs, labels.filter(~held))
    return toxicity.score(docs, model).withColumn("held_out", held)


@query("op5_secret_scan")
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of all documents; the forest learns from format-labelled findings outside the held-out fifth.

    Words of one case are listed only where the forest takes them for secrets.
    """
    docs = table(spark, sf_dir, "documents")
    found = written(secrets.candidates(docs, secrets.dictionary_of(docs)), "candidates")
    held = id_crc() % 5 == 0
    labelled = found.withColumn("label", secrets.format_labels()).filter(~held & F.col("label").isNotNull())
    scored = secrets.scan(found, secrets.fit_forest(labelled))
    listed = scored.filter(F.col("is_secret") | ~F.col("value").rlike(secrets.ORDINARY) | (F.col("kind") == "assigned"))
    return listed.select("doc_id", "start", "stop", "kind", F.sha2("value", 256).alias("value_sha256"), "score", "is_secret",
                         held.alias("held_out"))


@query("op8_license_scan")
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("spans")


@query("op11_merkle_manifest", merkle.oracle())
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tampering lower-cases the texts of a fifth of the documents; their leaves are then folded with the old siblings."""
    docs = table(spark, sf_dir, "documents")
    lowered = F.translate("text", UPPER, UPPER.lower())
    suspect = F.when(id_crc() % 5 == 0, merkle.leaf(text=lowered))
    leaves = written(docs.select("doc_id", "source", merkle.leaf().alias("leaf"), suspect.alias("suspect")), "leaves")
    found = merkle.manifest(leaves).withColumn("folded_root", merkle.fold(F.coalesce("suspect", "leaf"), F.col("path")))
    return found.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), "folded_root",
                        (F.col("folded_root") == F.col("root")).alias("verified"))


@query("op12_fill_middle", fill_middle.oracle())
def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.fim(table(spark, sf_dir, "documents"))


@query("op13_best_fit_packing")
def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return packing.pack_documents(table(spark, sf_dir, "documents"), f.read())
