"""Rewriting, sizes and export."""

from pyspark.sql import functions as F

from ddlscope.fixed import PREVIEW_OBJECTS
from ddlscope.functions.ddl import discard_catalog, export_chunk
from ddlscope.functions.sizes import json_bytes, size_verdict
from ddlscope.operators import sizing
from ddlscope.session import scratch_path
from ddlscope.sinks import manifest, payload
from workload.queries.selection import objects
from ddlscope.operators.selection import to_export
from workload.registry import query
from workload.sql import KEYS, SELECTED, chunk, discard
from workload.sql import json_bytes as sql_json_bytes

_CHUNKS = SELECTED + f""",
exported AS (SELECT {KEYS}, ddl FROM selected_objects WHERE selected AND length(ddl) > 0),
chunks AS (SELECT {KEYS}, {chunk()} AS chunk FROM exported)"""
_BULK = f"chunks AS (SELECT catalog_name, schema_name, object_name, l_returnflag, {chunk(catalog="'main'")} AS chunk FROM fx_bulk)"
_ENVELOPE = manifest.envelope_bytes(sourceFormat="ddl", strictMode=False, revisionName="Import")


def exported(t):
    return to_export(objects(t))


def chunks(t):
    return sizing.with_chunk(exported(t))


def bulk_chunks(t):
    return t("fx_bulk").withColumn("chunk", export_chunk(catalog=F.lit("main")))


@query(f"SELECT {KEYS}, {discard('ddl', 'catalog_name')} AS ddl FROM fx_ddl")
def c5_discard_catalog(t):
    ddl = discard_catalog("ddl", "catalog_name").alias("ddl")
    return t("fx_ddl").select("catalog_name", "schema_name", "object_name", ddl)


@query(f"""SELECT object_name, {discard('ddl', "'main'")} AS ddl FROM fx_bulk""")
def c5_discard_catalog_bulk(t):
    return t("fx_bulk").select("object_name", discard_catalog("ddl", F.lit("main")).alias("ddl"))


@query(f"""SELECT {KEYS}, {discard('ddl', 'catalog_name')} AS ddl FROM (
             SELECT catalog_name, schema_name, object_name,
               replace(replace(ddl, 'main', 'Spark_Catalog'), 'hive_metastore', 'SPARK_CATALOG') AS ddl FROM fx_ddl)""")
def u2_hive_aliases(t):
    other_name = F.replace(F.replace("ddl", F.lit("main"), F.lit("Spark_Catalog")), F.lit("hive_metastore"), F.lit("SPARK_CATALOG"))
    return t("fx_ddl").select("catalog_name", "schema_name", "object_name",
                              discard_catalog(other_name, "catalog_name").alias("ddl"))


@query(f"WITH {_CHUNKS} SELECT * FROM chunks")
def c6_export_chunk(t):
    return chunks(t).select("catalog_name", "schema_name", "object_name", "chunk")


@query(f"SELECT {KEYS}, {chunk(keep=True)} AS chunk FROM fx_ddl")
def c6_export_chunk_keeping_catalog(t):
    return sizing.with_chunk(t("fx_ddl"), keep_catalog=True).select("catalog_name", "schema_name", "object_name", "chunk")


@query(f"""WITH {_CHUNKS} SELECT catalog_name, count(*) AS objects,
             CAST(sum(octet_length(encode(chunk))) + count(*) - 1 AS BIGINT) AS raw_bytes FROM chunks GROUP BY catalog_name""")
def a9_payload_bytes(t):
    return sizing.payload_sizes(chunks(t)).drop("body_bytes")


@query(f"""WITH {_BULK} SELECT l_returnflag, count(*) AS objects,
             CAST(sum(octet_length(encode(chunk))) + count(*) - 1 AS BIGINT) AS raw_bytes FROM chunks GROUP BY l_returnflag""")
def a9_payload_bytes_bulk(t):
    return sizing.payload_sizes(bulk_chunks(t), ["l_returnflag"]).drop("body_bytes")


@query(f"""WITH {_CHUNKS} SELECT catalog_name, CAST(sum({sql_json_bytes('chunk')}) + (count(*) - 1) * 2 + {_ENVELOPE} AS BIGINT)
             AS body_bytes FROM chunks GROUP BY catalog_name""")
def a10_body_bytes(t):
    return sizing.payload_sizes(chunks(t), envelope_bytes=_ENVELOPE).drop("objects", "raw_bytes")


@query(f"""WITH {_BULK} SELECT l_returnflag, CAST(sum({sql_json_bytes('chunk')}) + (count(*) - 1) * 2 AS BIGINT) AS body_bytes
           FROM chunks GROUP BY l_returnflag""")
def a10_body_bytes_bulk(t):
    return sizing.payload_sizes(bulk_chunks(t), ["l_returnflag"]).drop("objects", "raw_bytes")


@query(f"SELECT doc_id, CAST({sql_json_bytes('text')} AS BIGINT) AS text_bytes FROM documents")
def a10_text_bytes(t):
    return t("documents").select("doc_id", json_bytes("text").alias("text_bytes"))


@query(f"""WITH {_CHUNKS}, sizes AS (SELECT catalog_name, sum(octet_length(encode(chunk))) + count(*) - 1 AS raw_bytes,
             sum({sql_json_bytes('chunk')}) + (count(*) - 1) * 2 AS body_bytes FROM chunks GROUP BY catalog_name)
           SELECT catalog_name, CASE WHEN raw_bytes > 104857600 THEN 'uncompressed' ELSE 'ok' END AS preview_verdict,
             CASE WHEN body_bytes > 104857600 THEN 'uncompressed' ELSE 'ok' END AS submit_verdict,
             CASE WHEN body_bytes > 65536 THEN 'uncompressed' ELSE 'ok' END AS small_limit_verdict FROM sizes""")
def a12_size_verdict(t):
    return sizing.payload_sizes(chunks(t)).select(
        "catalog_name", size_verdict("raw_bytes").alias("preview_verdict"), size_verdict("body_bytes").alias("submit_verdict"),
        size_verdict("body_bytes", raw_limit=65536).alias("small_limit_verdict"))


@query(f"""WITH {_CHUNKS} SELECT catalog_name, line, count(*) AS times
           FROM (SELECT catalog_name, unnest(string_split(chunk, chr(10))) AS line FROM chunks) GROUP BY ALL""")
def k1_payload(t):
    path = scratch_path(t.spark, "payload")
    payload.write_payload(exported(t), path)
    return (payload.read_payload(t.spark, path).groupBy("catalog_name", F.col("value").alias("line"))
            .agg(F.count("*").alias("times")))


@query(f"""WITH {_CHUNKS} SELECT catalog_name, CAST(sum(octet_length(encode(chunk))) + count(*) - 1 AS BIGINT) AS raw_bytes,
             CAST(sum({sql_json_bytes('chunk')}) + (count(*) - 1) * 2 AS BIGINT) AS body_bytes FROM chunks
           GROUP BY catalog_name""")
def k1_text_sizes(t):
    path = scratch_path(t.spark, "payload")
    payload.write_payload(exported(t), path)
    return payload.text_sizes(t.spark, path)


# A limit that the longest texts alone break half of, so that both rules of the packing apply.
PACKED = 380
_PACKED = _CHUNKS + f""",
sized AS (SELECT {KEYS}, chunk, octet_length(encode(chunk)) AS bytes, row_number() OVER listed AS position,
    sum(octet_length(encode(chunk)) + 1) OVER listed AS e FROM chunks
  WINDOW listed AS (PARTITION BY catalog_name ORDER BY schema_name, lower(object_name), object_name)),
sections AS (SELECT *, bytes > {PACKED // 2} AS large, count(*) FILTER (bytes > {PACKED // 2}) OVER listed AS larges,
    coalesce(max(CASE WHEN bytes > {PACKED // 2} THEN e END) OVER listed, 0) AS last_end FROM sized
  WINDOW listed AS (PARTITION BY catalog_name ORDER BY position)),
packed AS (SELECT *, lpad(CAST(larges - large::INT AS STRING), 8, '0') || '-' || CASE WHEN large THEN 'large'
    ELSE lpad(CAST(CAST(floor((e - bytes - 1 - last_end) / {PACKED // 2}) AS BIGINT) AS STRING), 8, '0') END AS payload FROM sections)"""


@query(f"WITH {_PACKED} SELECT {KEYS}, payload, position, CAST(bytes AS BIGINT) AS bytes FROM packed")
def k1_packed_places(t):
    return payload.places(exported(t), PACKED)


# The digest is of the whole file, so it tells the order of its texts.
@query(f"""WITH {_PACKED} SELECT catalog_name, payload, count(*) AS objects, min(position) AS first_position, max(position) AS last_position,
             CAST(sum(bytes + 1) - 1 AS BIGINT) AS raw_bytes, CAST(sum(bytes + 1) AS BIGINT) AS file_bytes,
             sha256(string_agg(chunk, chr(10) ORDER BY position) || chr(10)) AS sha256,
             CASE WHEN sum(bytes + 1) - 1 > {PACKED} THEN 'uncompressed' ELSE 'ok' END AS raw_verdict,
             CASE WHEN sum(bytes + 1) - 1 > {PACKED} THEN 'uncompressed' ELSE 'ok' END AS wire_verdict FROM packed GROUP BY catalog_name, payload""")
def k1_packed_payloads(t):
    return payload.write_packed(exported(t), scratch_path(t.spark, "packed"), PACKED, compression="none")


# What the ends of the written files say, against the sizes of the texts.
@query(f"""WITH {_CHUNKS} SELECT catalog_name, CAST(sum(octet_length(encode(chunk))) + count(*) - 1 AS BIGINT) AS raw_bytes
           FROM chunks GROUP BY catalog_name""")
def a11_written_bytes(t):
    path = scratch_path(t.spark, "payload")
    payload.write_payload(exported(t), path)
    return payload.written_sizes(t.spark, path).select("catalog_name", "raw_bytes")


@query(f"WITH {_BULK} SELECT 'main' AS catalog_name, CAST(sum(octet_length(encode(chunk))) + count(*) - 1 AS BIGINT) AS raw_bytes FROM chunks")
def a11_written_bytes_bulk(t):
    path = scratch_path(t.spark, "payload")
    payload.write_payload(t("fx_bulk"), path)
    return payload.written_sizes(t.spark, path).select("catalog_name", "raw_bytes")


# Bytes as gzip writes them have no SQL form.
@query()
def a11_wire_bytes(t):
    path = scratch_path(t.spark, "payload")
    payload.write_payload(t("fx_bulk"), path)
    return payload.wire_sizes(t.spark, path)


@query("""WITH bodies AS (SELECT *, CASE WHEN length(diagram_name) > 0 THEN ',"addToDiagram":[{"subjectArea":null,"diagramName":'
              || CAST(to_json(diagram_name) AS STRING) || '}]}' ELSE '}' END AS rest,
              '"sourceFormat":"ddl","payload":' || CAST(to_json(payload_path) AS STRING) AS source,
              '"revisionName":' || CAST(to_json(revision_name) AS STRING) AS revision FROM fx_requests)
          SELECT request_id, CASE WHEN project_id IS NULL THEN '/projects' ELSE '/projects/' || project_id
              || CASE WHEN branch_id <> 0 THEN '/branches/' || branch_id ELSE '' END || '/revisions/'
              || CASE WHEN revision_id <> 0 THEN CAST(revision_id AS STRING) ELSE 'last' END END AS target,
            CASE WHEN project_id IS NULL THEN '{"dbType":' || CAST(to_json(db_type) AS STRING) || ',"projectName":'
              || CAST(to_json(project_name) AS STRING) || ',' || source || ',' || revision || rest
            ELSE '{' || source || ',"strictMode":' || CAST(strict AS STRING) || ',' || revision || rest END AS body
          FROM bodies""")
def k2_submissions(t):
    return manifest.submissions(t("fx_requests"))


@query("""SELECT request_id, '/projects/' || project_id || '/branches' AS target, '{"branchName":'
            || CAST(to_json(branch_name) AS STRING) || ',"revisionName":' || CAST(to_json(revision_name) AS STRING) || '}'
            AS body FROM fx_requests WHERE project_id IS NOT NULL""")
def k2_branch_requests(t):
    return manifest.branch_requests(t("fx_requests").where("project_id IS NOT NULL"))


@query(f"""WITH {_CHUNKS} SELECT row_number() OVER (PARTITION BY catalog_name ORDER BY schema_name, lower(object_name), object_name)
             AS position, {KEYS}, chunk FROM chunks QUALIFY position <= 200""")
def k3_preview(t):
    return sizing.preview(exported(t), t("fx_ddl"), PREVIEW_OBJECTS)


@query(f"WITH {_CHUNKS} SELECT catalog_name, count(*) AS objects, least(count(*), 200) AS shown FROM chunks GROUP BY ALL")
def k3_preview_counts(t):
    return sizing.preview_counts(exported(t), PREVIEW_OBJECTS)
