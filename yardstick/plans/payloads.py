"""Registered queries for inference inputs: shuffle/slice/batch, payloads per model
family, data URIs, media types and the label-list text (L1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import payloads as P
from ..functions import labels as L
from ..operators import batching
from ..sources import derived
from .oracle_common import G_CTE, with_ctes

SEED = 42
BATCH = 100
# The prompt text is a caller parameter; this one is the engine's own wording.
PROMPT = "Compare the two images and answer Yes if the generated one shows the same product, otherwise No."
SYSTEM = "You judge image pairs."
EXTS = [".png", ".JPG", ".jpeg", ".gif", ".bmp", ".webp", ".tiff", ""]


def pair_rows(spark, sf):
    """Pages as an image-pair dataset: the page bytes stand in for the source image and
    the URL bytes for the generated one; every third page lacks the generated image."""
    pages = derived.read_table(spark, sf, "pages")
    ext = F.element_at(F.array(*[F.lit(e) for e in EXTS]), (F.col("page_id") % len(EXTS) + 1).cast("int"))
    return pages.select(
        F.col("page_id").alias("sample_id"),
        F.encode("html", "UTF-8").alias("source_image_main"),
        F.when(F.col("page_id") % 3 != 0, F.encode("url", "UTF-8")).alias("generated_image"),
        F.encode("url", "UTF-8").alias("target_bytes"),
        F.concat(F.lit("img/"), F.col("page_id").cast("string"), ext).alias("image_path"),
        "url",
    )


def _images(df):
    return [("source_image_main", F.col("source_image_main")), ("generated_image", F.col("target_bytes"))]


def q_slice_batches(spark, sf):
    docs = derived.read_table(spark, sf, "documents").select(F.col("doc_id").alias("sample_id"))
    b = batching.slice_batches(batching.positions(docs, SEED), batch_size=BATCH)
    return b.select("sample_id", "pos", "record_id", "batch_idx")


def q_batch_manifest(spark, sf):
    docs = derived.read_table(spark, sf, "documents").select(F.col("doc_id").alias("sample_id"))
    b = batching.slice_batches(batching.positions(docs, SEED), batch_size=BATCH)
    return batching.batch_manifest(b, "bucket", "proj/batch_input", "eval", "2024-01-01-00-00-00")


EVAL_SUBSET = 300  # BAT-5's head size is a parameter (the reference's default is 3000)


def q_eval_subset(spark, sf):
    """BAT-4/BAT-5: the first ``EVAL_SUBSET`` rows of the seeded shuffle, with positions;
    the limit is the operator itself (top-k of (hash, id) pairs, ids broadcast back)."""
    docs = derived.read_table(spark, sf, "documents").select(F.col("doc_id").alias("sample_id"), "lang", "n_chars")
    return batching.seeded_head(docs, EVAL_SUBSET, SEED).select("sample_id", "pos", "lang", "n_chars")


def _family_query(spark, sf, family):
    df = pair_rows(spark, sf)
    rid = F.concat(F.lit("sample_"), F.col("sample_id").cast("string"))
    return df.select("sample_id", P.payload(rid, _images(df), PROMPT, family).alias("j"))


def _md5_path(path):
    return F.md5(F.get_json_object("j", path))


def q_payload_claude(spark, sf):
    d = _family_query(spark, sf, "claude")
    c = "$.modelInput.messages[0].content"
    return d.select(
        "sample_id",
        F.get_json_object("j", "$.recordId").alias("record_id"),
        F.get_json_object("j", "$.modelInput.max_tokens").cast("bigint").alias("max_tokens"),
        F.get_json_object("j", "$.modelInput.anthropic_version").alias("version"),
        F.json_array_length(F.get_json_object("j", c)).cast("bigint").alias("n_blocks"),
        F.get_json_object("j", c + "[0].text").alias("label0"),
        F.get_json_object("j", c + "[2].text").alias("label2"),
        F.get_json_object("j", c + "[1].source.media_type").alias("media"),
        _md5_path(c + "[1].source.data").alias("img1_md5"),
        _md5_path(c + "[3].source.data").alias("img2_md5"),
        F.get_json_object("j", c + "[4].text").alias("prompt"),
    )


def q_payload_nova(spark, sf):
    d = _family_query(spark, sf, "nova")
    c = "$.modelInput.messages[0].content"
    return d.select(
        "sample_id",
        F.get_json_object("j", "$.recordId").alias("record_id"),
        F.json_array_length(F.get_json_object("j", c)).cast("bigint").alias("n_blocks"),
        F.get_json_object("j", c + "[0].text").alias("label0"),
        F.get_json_object("j", c + "[0].type").alias("type0"),
        F.get_json_object("j", c + "[1].image.format").alias("format"),
        _md5_path(c + "[1].image.source.bytes").alias("img1_md5"),
        _md5_path(c + "[3].image.source.bytes").alias("img2_md5"),
    )


def q_payload_llama(spark, sf):
    d = _family_query(spark, sf, "llama")
    return d.select(
        "sample_id",
        F.get_json_object("j", "$.recordId").alias("record_id"),
        F.get_json_object("j", "$.modelInput.max_gen_len").cast("bigint").alias("max_gen_len"),
        _md5_path("$.modelInput.prompt").alias("prompt_md5"),
    )


def q_payload_mistral(spark, sf):
    d = _family_query(spark, sf, "mistral")
    return d.select(
        "sample_id",
        F.get_json_object("j", "$.recordId").alias("record_id"),
        F.get_json_object("j", "$.modelInput.max_tokens").cast("bigint").alias("max_tokens"),
        _md5_path("$.modelInput.prompt").alias("prompt_md5"),
    )


MODEL_IDS = ["", "anthropic.claude-x", "amazon.nova-pro", "qwen3-vl", "meta.llama4", "mistral.large", "other.model"]


def q_payload_router(spark, sf):
    df = pair_rows(spark, sf)
    mid = F.element_at(F.array(*[F.lit(m) for m in MODEL_IDS]), (F.col("sample_id") % len(MODEL_IDS) + 1).cast("int"))
    rid = F.concat(F.lit("sample_"), F.col("sample_id").cast("string"))
    j = P.routed_payload(rid, _images(df), PROMPT, mid)
    d = df.select("sample_id", mid.alias("model_id"), P.family_col(mid).alias("family"), j.alias("j"), P.payload_error(_images(df), P.family_col(mid)).alias("error"))
    c = "$.modelInput.messages[0].content"
    return d.select(
        "sample_id",
        "model_id",
        "family",
        F.coalesce(F.get_json_object("j", "$.modelInput.max_tokens"), F.get_json_object("j", "$.modelInput.max_gen_len")).cast("bigint").alias("limit"),
        F.json_array_length(F.get_json_object("j", c)).cast("bigint").alias("n_blocks"),
        F.get_json_object("j", "$.modelInput.prompt").isNotNull().alias("has_prompt"),
        "error",
    )


def q_slice_range(spark, sf):
    """BAT-1 + BAT-19 ranges: 400 rows from position 150 on, and of their batches 1 and 2."""
    docs = derived.read_table(spark, sf, "documents").select(F.col("doc_id").alias("sample_id"))
    b = batching.slice_batches(batching.positions(docs, SEED), batch_size=BATCH, start=150, max_samples=400)
    m = batching.batch_manifest(b, "bucket", "proj/data", "eval", "2024-01-01-00-00-00", batch_start=1, batch_end=3)
    return b.join(m.select("batch_idx", "n_records", "output_uri"), "batch_idx").select("sample_id", "pos", "batch_idx", "n_records", "output_uri")


def q_model_folders(spark, sf):
    """BAT-20 per row: folder names from model ids and output prefixes from input prefixes."""
    pages = derived.read_table(spark, sf, "pages")
    prefix = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("input/"), F.col("url"))).otherwise(F.lit("data"))
    return pages.select("page_id", batching.safe_model_name(F.col("url")).alias("folder"), batching.output_prefix_col(prefix).alias("output_prefix"))


def q_payload_chat(spark, sf):
    df = pair_rows(spark, sf)
    imgs = [("SOURCE IMAGE", F.col("source_image_main")), ("GENERATED IMAGE", F.col("generated_image"))]
    rid = F.concat(F.lit("sample_"), F.col("sample_id").cast("string"))
    gt = (F.col("sample_id") % 2 == 0)
    j = P.envelope(rid, P.chat_payload(imgs, PROMPT, SYSTEM), gt)
    d = df.select("sample_id", j.alias("j"), P.required_images_error([("source_image_main", F.col("source_image_main")), ("generated_image", F.col("generated_image"))]).alias("error"))
    u = "$.payload.messages[1].content"
    return d.select(
        "sample_id",
        F.get_json_object("j", "$.record_id").alias("record_id"),
        F.get_json_object("j", "$.ground_truth").cast("boolean").alias("ground_truth"),
        F.get_json_object("j", "$.payload.messages[0].role").alias("role0"),
        F.json_array_length(F.get_json_object("j", u)).cast("bigint").alias("n_parts"),
        F.get_json_object("j", u + "[0].text").alias("text0"),
        _md5_path(u + "[1].image_url.url").alias("url1_md5"),
        F.get_json_object("j", "$.payload.max_tokens").cast("bigint").alias("max_tokens"),
        F.get_json_object("j", "$.payload.temperature").cast("double").alias("temperature"),
        "error",
    )


def q_data_uri(spark, sf):
    df = pair_rows(spark, sf)
    return df.select(
        "sample_id",
        F.md5(P.data_uri("source_image_main", P.mime_type("image_path"))).alias("uri_md5"),
        F.length(P.b64("source_image_main")).cast("bigint").alias("b64_len"),
    )


def q_mime_type(spark, sf):
    df = pair_rows(spark, sf)
    return df.select("sample_id", "image_path", P.mime_type("image_path").alias("mime"), P.mime_type("url").alias("url_mime"))


def q_label_list_text(spark, sf):
    """BAT-17 over data: each split's sampling categories rendered as a label list in
    sorted order, with the row count as the description."""
    g = derived.ground_truth(spark, sf)
    cats = g.select(F.col("dataset").alias("split"), F.coalesce(L.sampling_category("rejection_reason", "dataset", ["pairs-r"]), F.lit("(none)")).alias("category"))
    counts = cats.groupBy("split", "category").agg(F.count(F.lit(1)).alias("n"))
    lines = F.concat(F.lit("- '"), F.col("category"), F.lit("': "), F.col("n").cast("string"), F.lit(" rows"))
    per = counts.groupBy("split").agg(F.sort_array(F.collect_list(F.struct("category", lines.alias("line")))).alias("ls"))
    return per.select("split", F.concat(F.lit("Labels (use one):\n"), F.array_join(F.transform("ls", lambda x: x["line"]), "\n")).alias("text"))


QUERIES = {
    "slice_range": q_slice_range,
    "model_folders": q_model_folders,
    "slice_batches": q_slice_batches,
    "batch_manifest": q_batch_manifest,
    "eval_subset": q_eval_subset,
    "payload_claude": q_payload_claude,
    "payload_nova": q_payload_nova,
    "payload_llama": q_payload_llama,
    "payload_mistral": q_payload_mistral,
    "payload_router": q_payload_router,
    "payload_chat": q_payload_chat,
    "data_uri": q_data_uri,
    "mime_type": q_mime_type,
    "label_list_text": q_label_list_text,
}

_POS = f"""WITH d AS (SELECT doc_id AS sample_id,
       row_number() OVER (ORDER BY md5('{SEED}:' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS pos FROM documents),
b AS (SELECT sample_id, CAST(pos AS BIGINT) AS pos, 'sample_' || CAST(sample_id AS VARCHAR) AS record_id,
             CAST(pos // {BATCH} AS BIGINT) AS batch_idx FROM d)
"""
_PG = """WITH pg AS (SELECT page_id AS sample_id, html, url, to_base64(encode(html)) AS b1, to_base64(encode(url)) AS b2 FROM pages)
"""
_LL = "<|begin_of_text|><|start_header_id|>user<|end_header_id|>' || chr(10) || chr(10) || '"
_LA = "<|eot_id|><|start_header_id|>assistant<|end_header_id|>' || chr(10) || chr(10) || '"
_ext_cases = " ".join(f"WHEN {i} THEN '{e}'" for i, e in enumerate(EXTS))
_MIME = """CASE lower(regexp_extract(regexp_extract(p, '[^/]*$', 0), '^.+(\\.[^.]+)$', 1))
  WHEN '.png' THEN 'image/png' WHEN '.jpg' THEN 'image/jpeg' WHEN '.jpeg' THEN 'image/jpeg'
  WHEN '.gif' THEN 'image/gif' WHEN '.bmp' THEN 'image/bmp' WHEN '.webp' THEN 'image/webp' ELSE 'image/jpeg' END"""
_MODEL_CASES = " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(MODEL_IDS))

ORACLE = {
    "slice_batches": _POS + "SELECT * FROM b",
    "eval_subset": _POS + f"""
SELECT b.sample_id, b.pos, d.lang, d.n_chars FROM b JOIN documents d ON d.doc_id = b.sample_id WHERE b.pos < {EVAL_SUBSET}
""",
    "batch_manifest": _POS + """
SELECT batch_idx, CAST(count(*) AS BIGINT) AS n_records,
       's3://bucket/proj/batch_input/batch_' || CAST(batch_idx AS VARCHAR) || '.jsonl' AS input_uri,
       's3://bucket/proj/batch_output/batch_' || CAST(batch_idx AS VARCHAR) || '/' AS output_uri,
       'eval-batch-' || CAST(batch_idx AS VARCHAR) || '-2024-01-01-00-00-00' AS job_name
FROM b GROUP BY batch_idx
""",
    "payload_claude": _PG + f"""
SELECT sample_id, 'sample_' || CAST(sample_id AS VARCHAR) AS record_id, CAST(20000 AS BIGINT) AS max_tokens,
       'bedrock-2023-05-31' AS version, CAST(5 AS BIGINT) AS n_blocks, '[Source Image Main]' AS label0,
       '[Generated Image]' AS label2, 'image/jpeg' AS media, md5(b1) AS img1_md5, md5(b2) AS img2_md5,
       '{PROMPT}' AS prompt FROM pg
""",
    "payload_nova": _PG + """
SELECT sample_id, 'sample_' || CAST(sample_id AS VARCHAR) AS record_id, CAST(5 AS BIGINT) AS n_blocks,
       '[Source Image Main]' AS label0, CAST(NULL AS VARCHAR) AS type0, 'jpeg' AS format, md5(b1) AS img1_md5, md5(b2) AS img2_md5 FROM pg
""",
    "payload_llama": _PG + f"""
SELECT sample_id, 'sample_' || CAST(sample_id AS VARCHAR) AS record_id, CAST(20000 AS BIGINT) AS max_gen_len,
       md5('{_LL}[Source Image Main]' || chr(10) || '<|image|>' || b1 || chr(10) ||
           '[Generated Image]' || chr(10) || '<|image|>' || b2 || chr(10) || '{PROMPT}{_LA}') AS prompt_md5 FROM pg
""",
    "payload_mistral": _PG + f"""
SELECT sample_id, 'sample_' || CAST(sample_id AS VARCHAR) AS record_id, CAST(20000 AS BIGINT) AS max_tokens,
       md5('<s>[INST] ' || chr(10) || '[Source Image Main]: ' || b1 || ',' || chr(10) ||
           '[Generated Image]: ' || b2 || chr(10) || '{PROMPT} [/INST]') AS prompt_md5 FROM pg
""",
    "slice_range": f"""
WITH p AS (SELECT doc_id AS sample_id, row_number() OVER (ORDER BY md5('{SEED}:' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS pos FROM documents),
b AS (SELECT *, (pos - 150) // {BATCH} AS batch_idx FROM p WHERE pos >= 150 AND pos < 550)
SELECT sample_id, pos, CAST(batch_idx AS BIGINT) AS batch_idx, count(*) OVER (PARTITION BY batch_idx) AS n_records,
       's3://bucket/proj/data_output/batch_' || CAST(batch_idx AS VARCHAR) || '/' AS output_uri
FROM b WHERE batch_idx BETWEEN 1 AND 2
""",
    "model_folders": """
SELECT page_id, replace(replace(url, '/', '_'), chr(92), '_') AS folder,
       CASE WHEN page_id % 2 = 0 THEN replace('input/' || url, 'input', 'output') ELSE 'data_output' END AS output_prefix FROM pages
""",
    "payload_router": f"""
WITH m AS (SELECT page_id AS sample_id, CASE page_id % {len(MODEL_IDS)} {_MODEL_CASES} END AS model_id FROM pages),
f AS (SELECT *, CASE WHEN model_id = '' OR model_id LIKE '%claude%' THEN 'claude'
                     WHEN model_id LIKE '%nova%' OR model_id LIKE '%qwen%' THEN 'nova'
                     WHEN model_id LIKE '%meta%' THEN 'llama' WHEN model_id LIKE '%mistral%' THEN 'mistral'
                     ELSE 'unknown' END AS family FROM m)
SELECT sample_id, model_id, family, CAST(CASE WHEN family <> 'unknown' THEN 20000 END AS BIGINT) AS "limit",
       CAST(CASE WHEN family IN ('claude', 'nova') THEN 5 END AS BIGINT) AS n_blocks,
       family IN ('llama', 'mistral') AS has_prompt,
       CASE WHEN family = 'unknown' THEN 'no payload builder for family unknown' END AS error FROM f
""",
    "payload_chat": """
WITH pg AS (SELECT page_id AS sample_id, html, CASE WHEN page_id % 3 <> 0 THEN url END AS gen FROM pages)
SELECT sample_id, 'sample_' || CAST(sample_id AS VARCHAR) AS record_id, sample_id % 2 = 0 AS ground_truth,
       'system' AS role0, CAST(CASE WHEN gen IS NULL THEN 3 ELSE 5 END AS BIGINT) AS n_parts,
       chr(10) || '**SOURCE IMAGE**' AS text0,
       md5('data:image/jpeg;base64,' || to_base64(encode(html))) AS url1_md5,
       CAST(1024 AS BIGINT) AS max_tokens, CAST(0.8 AS DOUBLE) AS temperature,
       CASE WHEN gen IS NULL THEN 'no image in generated_image' END AS error
FROM pg
""",
    "data_uri": f"""
WITH pg AS (SELECT page_id AS sample_id, html, 'img/' || CAST(page_id AS VARCHAR) || CASE page_id % {len(EXTS)} {_ext_cases} END AS p FROM pages)
SELECT sample_id, md5('data:' || {_MIME} || ';base64,' || to_base64(encode(html))) AS uri_md5,
       CAST(length(to_base64(encode(html))) AS BIGINT) AS b64_len FROM pg
""",
    "mime_type": f"""
WITH pg AS (SELECT page_id AS sample_id, url, 'img/' || CAST(page_id AS VARCHAR) || CASE page_id % {len(EXTS)} {_ext_cases} END AS p FROM pages)
SELECT sample_id, p AS image_path, {_MIME} AS mime, {_MIME.replace('(p,', '(url,')} AS url_mime FROM pg
""",
    "label_list_text": with_ctes(G_CTE) + """,
c AS (SELECT dataset AS split, coalesce(CASE WHEN coalesce(CASE WHEN dataset = 'pairs-r' THEN rejection_reason IN ('accepted')
                               ELSE rejection_reason IN ('', 'accept') END, false)
          THEN 'accepted' ELSE rejection_reason END, '(none)') AS category FROM g),
n AS (SELECT split, category, count(*) AS n FROM c GROUP BY ALL)
SELECT split, 'Labels (use one):' || chr(10) || string_agg('- ''' || category || ''': ' || CAST(n AS VARCHAR) || ' rows', chr(10) ORDER BY category) AS text
FROM n GROUP BY split
""",
}
