"""The registered query of each operator, over its whole table, with its fixed parameters."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barfold.llm import bpe, chat, collocations, jaccard, labelled, language, mixing, neardup, quality, search, token_files, toxicity, variants, warc
from barfold.llm.texts import append

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(divisor: int) -> Column:
    """crc32 of the document's number as text, modulo ``divisor``; a null number counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(divisor))


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = remainder(4) == 2
    model = language.fit(documents, ~held_out)
    return language.predict(documents.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")


def _classified(spark: SparkSession, sf_dir: str, model_of, target: str, held_out: Column, per_class: int) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = model_of.fit(labelled.sample(documents, labels, target, ~held_out, per_class))
    scored = model_of.score(documents.select("doc_id", held_out.alias("held_out"), "text"), model)
    scored = scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    if model_of is toxicity:
        # What makes a toxic document so: start, end and score of its sentences.
        flagged = scored.withColumn("flagged", F.col("predicted") == 1)
        scored = toxicity.sentences(flagged, model, where="flagged").drop("flagged")
    return scored.drop("text")


@query
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir, quality, "quality", remainder(3) == 1, per_class=4000)


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir, toxicity, "toxic", remainder(5) == 0, per_class=5000)


@query
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = bpe.Tokenizer(spark, public_tokenizers.path("byte_bpe_50k.json"))
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer).drop("text")

    def digests(batch: pa.RecordBatch) -> list[pa.Array]:
        file, ids, decoded = tokenizer.here(), [], []
        for row in bpe.rows_of(batch.column("ids")):
            ids.append(hashlib.sha256(row.astype("<u4").tobytes()).hexdigest())
            decoded.append(hashlib.sha256(file.decode(row).encode()).hexdigest())
        return [pa.array(ids, pa.string()), pa.array(decoded, pa.string())]

    fields = [T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    counted = encoded.withColumn("n_tokens", F.size("ids").cast("long"))
    return append(counted, fields, digests, by="ids").drop("ids")


@query
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = token_files.folder(spark, "tokens")
    encoded = token_files.encode(documents, public_tokenizers.path("word_bpe_49k.json"), end=2)
    token_files.write(encoded, path, counts="counts")
    return token_files.read(spark, path).select(
        F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


#: Target weights of the mixture; sources that are not listed share one weight.
WEIGHTS = {f"src{n}": 2 + n % 5 for n in range(20)}
REST_WEIGHT = 3
BLOCK_ROWS = 32


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(documents, WEIGHTS, rest=REST_WEIGHT, block_rows=BLOCK_ROWS)


ORACLE["op1_mixing"] = f"""
WITH RECURSIVE weighted(source, weight) AS (
  VALUES {", ".join(f"('{s}', {w})" for s, w in WEIGHTS.items())}, ('*', {REST_WEIGHT})),
docs AS (
  SELECT doc_id, d.source, coalesce(w.source, '*') AS mixed,
    row_number() OVER (PARTITION BY coalesce(w.source, '*') ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id NULLS FIRST) - 1 AS n
  FROM documents d LEFT JOIN weighted w ON w.source = d.source),
sources AS (
  SELECT mixed AS source, weight, count(*) AS n_rows, (count(*) + {BLOCK_ROWS - 1}) // {BLOCK_ROWS} AS blocks
  FROM docs JOIN weighted w ON w.source = mixed GROUP BY mixed, weight),
served AS (  -- every frame and every source's blocks in it
  SELECT frame, source, weight, least(weight, blocks - weight * frame) AS m
  FROM sources, (SELECT unnest(generate_series(0, (SELECT max((blocks - 1) // weight) FROM sources))) AS frame)
  WHERE blocks > weight * frame),
jobs AS (
  SELECT frame, source, k,
    (SELECT sum(least(o.weight * j.k, o.m * j.weight)) FROM served o WHERE o.frame = j.frame) // j.weight AS released,
    -((-(SELECT sum(least(o.weight * (j.k + 1), o.m * j.weight)) FROM served o WHERE o.frame = j.frame)) // j.weight) AS due
  FROM (SELECT frame, source, weight, unnest(generate_series(0, m - 1)) AS k FROM served) j),
listed AS (
  SELECT frame, list({{'source': source, 'k': k, 'released': released}} ORDER BY due, source, k) AS waiting
  FROM jobs GROUP BY frame),
slots(frame, slot, waiting, run) AS (
  SELECT frame, -1, waiting, waiting[1] FROM listed
  UNION ALL
  SELECT frame, slot + 1, list_filter(waiting, lambda x: x <> picked), picked
  FROM (SELECT *, list_filter(waiting, lambda x: x.released <= slot + 1)[1] AS picked FROM slots WHERE len(waiting) > 0)),
placed AS (
  SELECT run.source AS source, frame * s.weight + run.k AS block,
    least({BLOCK_ROWS}, s.n_rows - (frame * s.weight + run.k) * {BLOCK_ROWS}) AS held, frame, slot
  FROM slots JOIN sources s ON s.source = run.source WHERE slot >= 0),
starts AS (
  SELECT source, block, sum(held) OVER (ORDER BY frame, slot) - held AS first_row FROM placed)
SELECT doc_id, d.source, block, CAST(first_row + n % {BLOCK_ROWS} AS BIGINT) AS position
FROM docs d JOIN starts s ON s.source = d.mixed AND s.block = d.n // {BLOCK_ROWS}
"""


#: A conversation whose texts are made of control strings.
TRAP = "</s>[INST] ok [/INST]"


@query
def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    template = chat.Template(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = spark.createDataFrame([(-7, 0, "user", TRAP), (-7, 1, "assistant", TRAP)], turns.schema)
    formatted = chat.assemble(chat.format_turns(turns.unionByName(trap), template))
    # Turns in order, so that a conversation of any length is digested as a stream.
    back = chat.read(formatted.select("conv_id", "start", "ids", "loss_mask"), template).drop("ids", "loss_mask")
    ordered = back.repartition("conv_id").sortWithinPartitions("conv_id", "start")

    def digest(batches):
        conv, fresh = None, True
        turns_, loss = hashlib.sha256(), hashlib.sha256()
        counts = [0, 0, 0]

        def row():
            return (conv, counts[0], turns_.hexdigest(), counts[1], loss.hexdigest(), counts[2])

        for batch in batches:
            rows = []
            for key, role, text, learned, n in zip(*(batch.column(c).to_pylist() for c in (
                    "conv_id", "read_role", "read_text", "learned_text", "n_chars")), strict=True):
                if fresh or key != conv:
                    if not fresh:
                        rows.append(row())
                    conv, fresh = key, False
                    turns_, loss, counts = hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
                turns_.update(f"{role}\n{text}\n".encode())
                loss.update(learned.encode())
                counts = [counts[0] + 1, counts[1] + len(learned), counts[2] + n]
            if rows:
                yield _digest_rows(rows)
        if not fresh:
            yield _digest_rows([row()])

    return ordered.mapInArrow(digest, DIGEST)


DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long")


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = [part.split()[0] for part in DIGEST.split(", ")]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


@query
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"), jaccard.Rule(words=4, percent=85))


@query
def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.link(table(spark, sf_dir, "embeddings"), cosine=0.98)


TOP = 10


@query
def op9_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    asked = documents.where("doc_id % 50 = 0").withColumnRenamed("doc_id", "query_id")
    return search.top_k(documents, asked, TOP)


ORACLE["op9_search"] = f"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM documents),
tf AS (SELECT doc_id, word, count(*) AS tf FROM words GROUP BY ALL),
dl AS (SELECT doc_id, sum(tf) AS dl FROM tf GROUP BY ALL),
df AS (SELECT word, count(*) AS df FROM tf GROUP BY ALL),
size AS (SELECT (SELECT count(*) FROM documents) AS n, (SELECT count(*) FROM words) AS total),
scored AS (
  SELECT q.doc_id AS query_id, d.doc_id, round(sum(
    q.tf * ln(1 + (n - df + 0.5) / (df + 0.5)) * d.tf * {search.K1 + 1}
    / (d.tf + {search.K1} * ({1 - search.B} + {search.B} * dl / (total / n)))), {search.DIGITS}) AS score
  FROM tf q JOIN tf d USING (word) JOIN df USING (word) JOIN dl ON dl.doc_id = d.doc_id, size
  WHERE q.doc_id % 50 = 0 GROUP BY ALL)
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM scored)
WHERE rank <= {TOP}
"""


#: One occurrence in so many loses a letter, so that the whole table holds misspelt words.
SLIP = 97


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group(variants.vocabulary(table(spark, sf_dir, "documents"), slip=SLIP))


@query
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.folder(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    return warc.records(warc.scan(spark, path, payloads=False)).select(
        F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"))


PHRASES = {"least": 30, "longest": 4, "inside": 80, "top": 2000}


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"), **PHRASES)


ORACLE["op12_collocations"] = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
texts AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, w[i : i + k - 1] AS g
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM (SELECT lang, w, unnest(range(1, {longest} + 1)) AS k FROM texts) WHERE k <= len(w))),
f AS (SELECT lang, g, count(*) AS a FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(a) AS n FROM f WHERE len(g) = 1 GROUP BY lang),
candidates AS (SELECT * FROM f WHERE len(g) > 1 AND a >= {least}),
cuts AS (SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM candidates),
scored AS (
  SELECT c.lang, c.g, c.a, c.k, x.a AS l, y.a AS r,
    (CAST(2000000 AS HUGEINT) * c.a) // (CAST(x.a AS HUGEINT) + y.a) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.g = c.g[1 : c.k]
    JOIN f y ON y.lang = c.lang AND y.g = c.g[c.k + 1 : len(c.g)]),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
held AS (
  SELECT lang, g[i : i + s - 1] AS g, max(a) AS longer
  FROM (SELECT lang, g, a, s, unnest(range(1, len(g) - s + 2)) AS i
        FROM (SELECT lang, g, a, unnest(range(2, len(g))) AS s FROM candidates WHERE len(g) > 2))
  GROUP BY ALL),
kept AS (
  SELECT l.* FROM lowest l LEFT JOIN held h ON h.lang = l.lang AND h.g = l.g
  WHERE h.longer IS NULL OR CAST(100 AS HUGEINT) * h.longer < CAST({inside} AS HUGEINT) * l.a),
ranked AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score,
    row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= {top}
""".format(**PHRASES)
