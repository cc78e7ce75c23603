"""The registered queries of this package, and SQL where SQL can state the result."""

from pyspark.sql import functions as F

from tillworks.llm import (
    decontamination,
    html_text,
    language,
    lines,
    mergepieces,
    merkle,
    packing,
    quality,
    resampling,
    simhash,
    substring,
    tokencount,
    vectors,
)

QUERIES = {}
ORACLES = {}
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def query(key: str, sql: str | None = None):
    def register(plan):
        QUERIES[key] = plan
        if sql is not None:
            ORACLES[key] = sql
        return plan

    return register


def tokenizer(name):
    """The place of a public tokenizer file, the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_substring_dedup")
def op1(spark, folder):
    cut = substring.remove_repeated_passages(_table(spark, folder, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op6_simhash_near_dedup")
def op6(spark, folder):
    return simhash.near_groups(_table(spark, folder, "documents"))


@query("op7_token_counts")
def op7(spark, folder):
    return tokencount.token_counts(
        _table(spark, folder, "documents"), tokenizer("piece_bpe_32k.model"), limit=4096
    )


@query("op8_packing")
def op8(spark, folder):
    pieces = packing.pack(
        _table(spark, folder, "documents"), tokenizer("word_bpe_49k.json"), length=4096, end=2
    )
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def _remainder(n):
    return F.crc32(F.col("doc_id").cast("string")) % n


@query("op3_language_id")
def op3(spark, folder):
    docs = _table(spark, folder, "documents")
    model = language.fit(docs.where(_remainder(4) != 2).select("doc_id", "text", "lang"))
    return language.predict(docs, model).withColumn("held_out", F.coalesce(_remainder(4) == 2, F.lit(False)))


@query("op4_quality_classifier")
def op4(spark, folder):
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    labels = _table(spark, folder, "labels").where(_remainder(3) != 1)
    model = quality.fit(docs, labels.select("doc_id", F.col("quality").alias("label")))
    return quality.score(docs, model).select(
        "doc_id",
        F.coalesce(_remainder(3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query("op9_html_extraction")
def op9(spark, folder):
    texts = html_text.extract_text(_table(spark, folder, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))


@query("op10_embedding_near_dedup")
def op10(spark, folder):
    return vectors.near_groups(_table(spark, folder, "embeddings"), least=0.9)


@query("op2_benchmark_decontamination")
def op2(spark, folder):
    return decontamination.find_passages(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark"), rate=0.1, window=48
    )


@query(
    "op5_line_dedup",
    """
    WITH split AS (
        SELECT doc_id, source, text, string_split(text, chr(10)) AS parts FROM documents
    ), rows AS (
        SELECT doc_id, source, place, parts[place] AS raw,
               trim(parts[place], chr(32) || chr(9) || chr(13) || chr(11) || chr(12)) AS line
        FROM (SELECT doc_id, source, parts, unnest(range(1, len(parts) + 1)) AS place FROM split)
    ), common AS (
        SELECT line, min(doc_id) AS first FROM rows WHERE line <> ''
        GROUP BY line HAVING count(DISTINCT source) >= 10
    ), marked AS (
        SELECT r.doc_id, r.place, r.raw, r.line <> '' AS solid,
               coalesce(r.doc_id > c.first, false) AS gone
        FROM rows r LEFT JOIN common c ON r.line = c.line
    ), totals AS (
        SELECT doc_id, count(*) FILTER (WHERE solid) AS n_lines,
               count(*) FILTER (WHERE gone) AS n_removed,
               coalesce(string_agg(raw, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '') AS text
        FROM marked GROUP BY doc_id
    )
    SELECT d.doc_id, coalesce(t.n_lines, 0) AS n_lines, coalesce(t.n_removed, 0) AS n_removed,
           CASE WHEN d.text IS NULL THEN NULL ELSE t.text END AS text
    FROM documents d LEFT JOIN totals t ON d.doc_id = t.doc_id
    """,
)
def op5(spark, folder):
    return lines.remove_boilerplate(_table(spark, folder, "documents"), min_sites=10)


@query(
    "op12_merkle_manifest",
    """
    WITH RECURSIVE table_step AS (
        SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
                    lambda a, z: xor(a >> 1, 3988292384 * (a & 1))) ORDER BY b) AS t
        FROM (SELECT unnest(range(0, 256))::BIGINT AS b)
    ), coded AS (
        SELECT doc_id, source, lang, n_chars, text, doc_id::VARCHAR AS id,
               list_reduce(list_concat([4294967295::BIGINT],
                           list_transform(range(1, len(doc_id::VARCHAR) + 1),
                                          lambda k: ascii(substr(doc_id::VARCHAR, k, 1))::BIGINT)),
                           lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])) AS crc
        FROM documents, table_step
    ), chosen AS (
        SELECT *, coalesce(xor(crc, 4294967295) % 5 = 0, false) AS touched FROM coded
    ), hashed AS (
        SELECT doc_id, source,
               sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
               sha256(head || coalesce(strlen(changed) || ':' || changed, '-')) AS shown
        FROM (
            SELECT *, coalesce(strlen(id) || ':' || id, '-')
                   || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-')
                   || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
                   CASE WHEN touched THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                    'abcdefghijklmnopqrstuvwxyz') ELSE text END AS changed
            FROM chosen
        )
    ), placed AS (
        SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
               row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
        FROM hashed
    ), nodes AS (
        SELECT tree::BIGINT AS tree, 0 AS level, place::BIGINT AS place, leaf AS digest,
               count(*) OVER (PARTITION BY tree) AS n
        FROM placed
        UNION ALL
        SELECT tree, level + 1, place // 16, sha256(string_agg(digest, '' ORDER BY place)), (any_value(n) + 15) // 16
        FROM nodes WHERE n > 1 GROUP BY tree, level, place // 16
    ), upper_nodes AS (
        SELECT 0 AS level, tree AS place, digest, count(*) OVER () AS n FROM nodes WHERE n = 1
        UNION ALL
        SELECT level + 1, place // 16, sha256(string_agg(digest, '' ORDER BY place)), (any_value(n) + 15) // 16
        FROM upper_nodes WHERE n > 1 GROUP BY level, place // 16
    ), runs AS (
        SELECT tree, level, place // 16 AS run, list(digest ORDER BY place) AS digests
        FROM nodes WHERE n > 1 GROUP BY tree, level, place // 16
        UNION ALL
        SELECT -1, level, place // 16, list(digest ORDER BY place)
        FROM upper_nodes WHERE n > 1 GROUP BY level, place // 16
    ), climb AS (
        SELECT doc_id, tree AS own, place AS leaf_place, tree, 0 AS level, place, shown AS folded, '' AS proof,
               (SELECT max(level) FROM nodes k WHERE k.tree = placed.tree) AS top
        FROM placed
        UNION ALL
        SELECT doc_id, own, leaf_place, up.tree, up.level + 1, up.place // 16,
               sha256(array_to_string(list_transform(digests, lambda d, i: if(i = up.place % 16 + 1, folded, d)), '')),
               proof || array_to_string(list_filter(digests, lambda d, i: i <> up.place % 16 + 1), ''), top
        FROM (
            SELECT * REPLACE (CASE WHEN tree >= 0 AND level = top THEN -1 ELSE tree END AS tree,
                              CASE WHEN tree >= 0 AND level = top THEN 0 ELSE level END AS level,
                              CASE WHEN tree >= 0 AND level = top THEN own ELSE place END AS place)
            FROM climb
        ) up JOIN runs r ON r.tree = up.tree AND r.level = up.level AND r.run = up.place // 16
    ), arrived AS (
        SELECT own, leaf_place, arg_max(folded, level + 1000 * (tree < 0)::INT) AS folded,
               arg_max(proof, level + 1000 * (tree < 0)::INT) AS proof
        FROM climb GROUP BY own, leaf_place
    )
    SELECT p.doc_id, p.leaf, s.digest AS subroot, r.digest AS root, sha256(a.proof) AS proof_sha256,
           a.folded AS folded_root, a.folded = r.digest AS verified
    FROM placed p JOIN arrived a ON a.own = p.tree AND a.leaf_place = p.place
    JOIN nodes s ON s.tree = p.tree AND s.n = 1
    CROSS JOIN (SELECT digest FROM upper_nodes WHERE n = 1) r
    """,
)
def op12(spark, folder):
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = _table(spark, folder, "documents").select(*fields)
    lowered = F.translate("text", _UPPER, _UPPER.lower())
    touched = F.coalesce(_remainder(5) == 0, F.lit(False))
    leaves = docs.select(
        "doc_id",
        "source",
        merkle.digest_of(fields).alias("digest"),
        F.when(touched, merkle.digest_of(fields, {"text": lowered})).alias("changed"),
    ).withColumn("presented", F.coalesce("changed", "digest"))
    manifest = merkle.build(leaves.drop("changed"), "source", [F.col("doc_id")])
    return merkle.verify(spark, manifest, "presented").select(
        "doc_id",
        F.lower(F.hex("digest")).alias("leaf"),
        "subroot",
        "root",
        F.sha2("siblings", 256).alias("proof_sha256"),
        "folded_root",
        "verified",
    )


@query(
    "op13_importance_resampling",
    """
    WITH table_step AS (
        SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
                    lambda a, z: xor(a >> 1, 3988292384 * (a & 1))) ORDER BY b) AS t
        FROM (SELECT unnest(range(0, 256))::BIGINT AS b)
    ), worded AS (
        SELECT side, doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM (SELECT 's' AS side, doc_id, text FROM documents
              UNION ALL SELECT 't', item_id, text FROM benchmark)
    ), features AS (
        SELECT side, doc_id, unnest(list_concat(words, list_transform(
                   range(1, len(words)), lambda k: words[k] || ' ' || words[k + 1]))) AS feature
        FROM worded
    ), codes AS (
        SELECT feature, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(
                   range(0, octet_length(encode(feature))),
                   lambda k: ('0x' || substr(hex(encode(feature)), 2 * k + 1, 2))::BIGINT)),
                   lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 10000 AS bucket
        FROM (SELECT DISTINCT feature FROM features), table_step
    ), placed AS (
        SELECT side, doc_id, bucket FROM features JOIN codes USING (feature)
    ), totals AS (
        SELECT count(*) FILTER (WHERE side = 's') AS all_s, count(*) FILTER (WHERE side = 't') AS all_t FROM placed
    ), gains AS (
        SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (all_s + 10000)) / ((s + 1)::DOUBLE * (all_t + 10000)))) AS gain
        FROM (SELECT bucket, count(*) FILTER (WHERE side = 's') AS s, count(*) FILTER (WHERE side = 't') AS t
              FROM placed GROUP BY bucket), totals
    ), weights AS (
        SELECT doc_id, count(*) AS n_features, floor(sum(gain) / count(*))::BIGINT AS weight
        FROM placed JOIN gains USING (bucket) WHERE side = 's' GROUP BY doc_id
    ), scored AS (
        SELECT doc_id, len(words) >= 20 AS able, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
               coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT + 0.5)
                   / 4294967296::DOUBLE)))::BIGINT AS score
        FROM worded LEFT JOIN weights USING (doc_id) WHERE side = 's'
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS place,
               count(*) OVER (PARTITION BY able) AS n
        FROM scored
    )
    SELECT doc_id, n_features, weight, score,
           CASE WHEN able AND place <= 25 * n // 100 THEN place END AS rank
    FROM ranked
    """,
)
def op13(spark, folder):
    return resampling.resample(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark"), percent=25, min_words=20
    )


@query("op11_sentencepiece_round_trip")
def op11(spark, folder):
    model = tokenizer("piece_bpe_32k.model")
    coded = mergepieces.encode(_table(spark, folder, "documents"), model).select(
        "doc_id",
        "ids",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
    )
    decoded = mergepieces.decode(coded, model, carry=["n_tokens", "ids_sha256"])
    return decoded.select("doc_id", "carried.*", F.sha2("text", 256).alias("decoded_sha256"))
