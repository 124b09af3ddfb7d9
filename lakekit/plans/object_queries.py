"""Object inventories, file catalogue, sheets and mime types."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.functions import fixed_values as fixed
from lakekit.functions import scalars
from lakekit.operators import sinks
from lakekit.plans.registry import query, table
from lakekit.session import scratch_path
from lakekit.sources import files, grid, inventory
from lakekit.sources.objects import read_objects

INVENTORY = r"""(SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#:]*)([^?#]*)', 1) AS bucket,
        regexp_replace(regexp_extract(url, '^[a-z]+://([^/?#:]*)([^?#]*)', 2), '^/', '') AS name FROM pages)"""


def _objects(spark, sf_dir):
    return inventory.inventory_from_urls(table(spark, sf_dir, "pages"), "url", "page_id")


@query("list_objects_prefix", f"SELECT bucket, name FROM {INVENTORY} WHERE starts_with(name, 'en/')")
def list_objects_prefix(spark, sf_dir):
    return inventory.list_objects(_objects(spark, sf_dir), prefix="/en/").select("bucket", "name")


@query("list_objects_range", f"SELECT bucket, name FROM {INVENTORY} WHERE name >= 'en/3' AND name < 'fr/2'")
def list_objects_range(spark, sf_dir):
    return inventory.list_objects(_objects(spark, sf_dir), start="en/3", end="fr/2").select("bucket", "name")


@query("list_common_prefixes", f"""
SELECT DISTINCT bucket, split_part(name, '/', 1) || '/' AS name FROM {INVENTORY} WHERE contains(name, '/')
""")
def list_common_prefixes(spark, sf_dir):
    return inventory.list_common_prefixes(_objects(spark, sf_dir), "/")


@query("list_buckets", f"SELECT DISTINCT bucket FROM {INVENTORY} WHERE starts_with(bucket, 'blog.')")
def list_buckets(spark, sf_dir):
    return inventory.list_buckets(_objects(spark, sf_dir), "blog.")


@query("object_metadata", """
SELECT lang || '/' || doc_id || '.txt' AS name, CAST(octet_length(encode(text)) AS BIGINT) AS length, 'text/plain' AS content_type
FROM documents
""")
def object_metadata(spark, sf_dir):
    """Documents put as named objects; the listings of the languages' folders give their metadata, no body is read."""
    path = scratch_path(spark, "named")
    named = table(spark, sf_dir, "documents").select(
        F.concat("lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"), F.encode("text", "UTF-8").alias("body"))
    put = inventory.put_objects(named, "name", "body", path)
    listed = [inventory.inventory_from_files(spark, path, "*.txt", prefix=f"/{lang}/") for lang in ("en", "fr", "de", "es")]
    found = reduce(DataFrame.unionByName, listed)
    return found.select("name", "length").join(put.select("name", "content_type"), "name")


# names that file scans pass over or cannot spell, and empty bodies
ODD_NAME = "CASE doc_id % 5 WHEN 0 THEN '_' WHEN 1 THEN '.' WHEN 2 THEN '_a/.b/' WHEN 3 THEN 'p%20 q/' ELSE '' END || lang || ' ' || doc_id"
ODD_BODY = "CASE WHEN doc_id % 7 = 0 THEN '' ELSE text END"


def _put_odd(spark, sf_dir):
    path = scratch_path(spark, "odd names")
    rows = table(spark, sf_dir, "documents").select(F.expr(ODD_NAME).alias("name"), F.encode(F.expr(ODD_BODY), "UTF-8").alias("body"))
    inventory.put_objects(rows, "name", "body", path)
    return path


@query("object_odd_names", f"SELECT {ODD_NAME} AS name, CAST(octet_length(encode({ODD_BODY})) AS BIGINT) AS length FROM documents")
def object_odd_names(spark, sf_dir):
    """Every object is listed: empty ones, hidden names and folders, blanks and percent signs."""
    return inventory.inventory_from_files(spark, _put_odd(spark, sf_dir)).select("name", "length")


@query("object_name_range", f"SELECT name FROM (SELECT {ODD_NAME} AS name FROM documents) WHERE name >= '.fr' AND name < '_b'")
def object_name_range(spark, sf_dir):
    """Bounds on the name go to the lister, which enters only folders that can hold such names."""
    return inventory.list_objects(read_objects(spark, _put_odd(spark, sf_dir)), start=".fr", end="_b").select("name")


@query("object_odd_texts", f"SELECT {ODD_NAME} AS name, {ODD_BODY} AS text FROM documents")
def object_odd_texts(spark, sf_dir):
    """The same objects read as text."""
    path = _put_odd(spark, sf_dir)
    return inventory.read_text_objects(spark, path).select(F.substring(F.col("path"), F.lit(len(path) + 2), F.length("path")).alias("name"), "text")


@query("object_odd_chunks", f"""
SELECT {ODD_NAME} AS name, CAST(greatest(1, ceil(octet_length(encode({ODD_BODY})) / 1000)) AS BIGINT) AS chunks,
       CAST(octet_length(encode({ODD_BODY})) AS BIGINT) AS length FROM documents
""")
def object_odd_chunks(spark, sf_dir):
    """The same objects as byte chunks."""
    path = _put_odd(spark, sf_dir)
    chunks = inventory.read_binary_chunks(spark, path, 1000)
    return chunks.groupBy(F.substring(F.col("path"), F.lit(len(path) + 2), F.length("path")).alias("name")).agg(
        F.count("*").alias("chunks"), F.sum(F.octet_length("bytes").cast("long")).alias("length"))


def _put_documents(spark, sf_dir):
    """All documents as line objects, one base64 line each, a bounded number of lines per object."""
    lines = table(spark, sf_dir, "documents").select(
        F.concat(F.col("doc_id").cast("string"), F.lit(" "), scalars.base64_text(F.encode("text", "UTF-8"))).alias("line"))
    return sinks.put_text_objects(lines, "line", scratch_path(spark, "objects"), max_lines=500)


def _documents(lines):
    return lines.select(
        F.split_part("line", F.lit(" "), F.lit(1)).cast("long").alias("doc_id"),
        F.unbase64(F.split_part("line", F.lit(" "), F.lit(2))).cast("string").alias("text"))


@query("write_objects_text", "SELECT doc_id, text FROM documents")
def write_objects_text(spark, sf_dir):
    return _documents(spark.read.text(_put_documents(spark, sf_dir)).toDF("line"))


@query("read_objects_text", "SELECT doc_id, text FROM documents")
def read_objects_text(spark, sf_dir):
    """Whole objects read as strict UTF-8, then split back into their lines."""
    objects = inventory.read_text_objects(spark, _put_documents(spark, sf_dir) + "/*.txt")
    return _documents(objects.select(F.explode(F.split(F.rtrim(F.col("text"), F.lit("\n")), "\n")).alias("line")))


@query("read_objects_binary", """
SELECT CAST(sum(length(CAST(doc_id AS VARCHAR)) + 2 + 4 * ((octet_length(encode(text)) + 2) // 3)) AS BIGINT) AS n_bytes
FROM documents
""")
def read_objects_binary(spark, sf_dir):
    """Objects streamed as bounded byte chunks; the chunks add up to every byte written."""
    chunks = inventory.read_binary_chunks(spark, _put_documents(spark, sf_dir) + "/*.txt", chunk=64 * 1024)
    return chunks.agg(F.sum(F.octet_length("bytes").cast("long")).alias("n_bytes"))


# ---------------------------------------------------------------- file catalogue
# Documents as files: language decides the file type, length the trash, source the owners.

FILES = f"""(SELECT doc_id, 'doc-' || doc_id AS id, source || '-' || doc_id AS name,
  CASE lang WHEN 'en' THEN '{fixed.DOCUMENT_MIME}' WHEN 'fr' THEN '{fixed.SPREADSHEET_MIME}'
            WHEN 'de' THEN '{fixed.PRESENTATION_MIME}'
            ELSE CASE WHEN n_chars > 1000 THEN '{fixed.FOLDER_MIME}' END END AS mime_type,
  n_chars AS size, n_chars < 200 AS trashed, source, lang FROM documents)"""


def _files(spark, sf_dir):
    lang, n_chars = F.col("lang"), F.col("n_chars")
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("doc-"), "doc_id").alias("id"), F.concat("source", F.lit("-"), "doc_id").alias("name"),
        F.when(lang == "en", fixed.DOCUMENT_MIME).when(lang == "fr", fixed.SPREADSHEET_MIME)
        .when(lang == "de", fixed.PRESENTATION_MIME).when(n_chars > 1000, fixed.FOLDER_MIME).alias("mime_type"),
        n_chars.alias("size"), (n_chars < 200).alias("trashed"), "source", "lang",
        F.array(F.struct(F.concat("source", F.lit("@example.org")).alias("email")),
                F.struct(F.when(n_chars > 1000, F.concat("lang", F.lit("@example.org"))).alias("email"))).alias("owners"))


@query("file_search", f"SELECT id, name, mime_type, size FROM {FILES} WHERE size > 500 AND lang <> 'es' AND NOT trashed")
def file_search(spark, sf_dir):
    return files.search(_files(spark, sf_dir), "size > 500 AND lang <> 'es'").select("id", "name", "mime_type", "size")


@query("file_lookup", f"SELECT id, name, mime_type, size FROM {FILES} WHERE id = 'doc-42'")
def file_lookup(spark, sf_dir):
    return files.lookup(_files(spark, sf_dir), "doc-42").select("id", "name", "mime_type", "size")


@query("file_is_folder", f"""
SELECT id, coalesce(mime_type = '{fixed.FOLDER_MIME}', false) AS is_folder FROM {FILES}
""")
def file_is_folder(spark, sf_dir):
    return _files(spark, sf_dir).select("id", files.is_folder(F.col("mime_type")).alias("is_folder"))


@query("array_filter_emails", f"""
SELECT id, source || '@example.org' || CASE WHEN size > 1000 THEN ',' || lang || '@example.org' ELSE '' END AS emails
FROM {FILES}
""")
def array_filter_emails(spark, sf_dir):
    return _files(spark, sf_dir).select("id", F.array_join(files.owner_emails(F.col("owners")), ",").alias("emails"))


TARGETS = ("PDF", "Word", "CSV", "ODP", "HTML", "PlainText")


# the formats a target can have, written out again, so that the library's table is checked against a second one
EXPORTS = """
 ('document', 'Word', 'application/vnd.openxmlformats-officedocument.wordprocessingml.document', 'docx'),
 ('document', 'PDF', 'application/pdf', 'pdf'), ('document', 'PlainText', 'text/plain', 'txt'), ('document', 'HTML', 'application/zip', 'zip'),
 ('spreadsheet', 'PDF', 'application/pdf', 'pdf'), ('spreadsheet', 'HTML', 'application/zip', 'zip'), ('spreadsheet', 'CSV', 'text/csv', 'csv'),
 ('presentation', 'ODP', 'application/vnd.oasis.opendocument.presentation', 'odp'), ('presentation', 'PDF', 'application/pdf', 'pdf'),
 ('presentation', 'PlainText', 'text/plain', 'txt')"""


@query("export_plan", f"""
WITH f AS (SELECT *, [{','.join(repr(t) for t in TARGETS)}][CAST(1 + size % {len(TARGETS)} AS INT)] AS target FROM {FILES}),
 d(kind, target, export_mime, extension) AS (VALUES {EXPORTS})
SELECT id, f.target, export_mime, f.name || '.' || extension AS output_name, extension IS NOT NULL AS is_valid
FROM f LEFT JOIN d ON CASE lang WHEN 'en' THEN 'document' WHEN 'fr' THEN 'spreadsheet' WHEN 'de' THEN 'presentation' END = d.kind
  AND f.target = d.target
""")
def export_plan(spark, sf_dir):
    wanted = F.get(F.array(*map(F.lit, TARGETS)), (F.col("size") % len(TARGETS)).cast("int"))
    return files.export_plan(_files(spark, sf_dir).withColumn("target", wanted)).select(
        "id", "target", "export_mime", "output_name", "is_valid")


@query("grid_to_table", "SELECT conv_id, turn, role, text FROM conversations")
def grid_to_table(spark, sf_dir):
    """Sheets of at most 50 turns per tab, header row first, read back into typed rows."""
    turns = table(spark, sf_dir, "conversations").select(
        "conv_id", F.floor(F.col("turn") / 50).alias("tab"), "turn",
        F.array(F.col("role"), F.col("turn").cast("string"), F.col("text")).alias("cells"))
    sheets = turns.groupBy("conv_id", "tab").agg(F.concat(
        F.array(F.array(F.lit("role"), F.lit("turn"), F.lit("text"))),
        F.transform(F.sort_array(F.collect_list(F.struct("turn", "cells"))), lambda r: r["cells"])).alias("values"))
    return grid.grid_to_table(sheets, "values", {"turn": "bigint", "role": "string", "text": "string"}).select(
        "conv_id", "turn", "role", "text")


# ---------------------------------------------------------------- scalar functions over pages

@query("object_url", f"""
SELECT page_id, 'gs://' || bucket || '/' || coalesce(nullif(name, ''), '') AS object_url FROM {INVENTORY}
""")
def object_url(spark, sf_dir):
    return _objects(spark, sf_dir).select("page_id", scalars.object_url(
        F.col("bucket"), F.nullif("name", F.lit(""))).alias("object_url"))


DECLARED = """CASE WHEN contains(url, 'spam-farm') THEN 'bogus' WHEN contains(url, '.html') THEN 'Text/HTML; charset=utf-8'
              WHEN contains(url, '#') THEN NULL WHEN contains(url, '?') THEN 'text/' ELSE 'text/html' END"""


@query("mime_normalize", f"""
SELECT page_id, CASE WHEN ct IN ('bogus', 'text/') THEN 'application/octet-stream' ELSE ct END AS content_type
FROM (SELECT page_id, {DECLARED} AS ct FROM pages)
""")
def mime_normalize(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", scalars.mime_normalize(F.expr(DECLARED)).alias("content_type"))


@query("mime_guess", f"""
WITH f AS (SELECT page_id, name || CASE WHEN page_id % 4 = 0 THEN '.PNG' WHEN page_id % 4 = 1 THEN CASE WHEN page_id % 8 = 1 THEN '.csv' ELSE '.doc' END
                  WHEN page_id % 4 = 2 THEN CASE WHEN page_id % 8 = 2 THEN '.unknown' ELSE '.webm' END ELSE '' END AS path FROM {INVENTORY})
SELECT page_id, CASE WHEN path LIKE '%/.%' THEN 'application/octet-stream' WHEN path LIKE '%.PNG' THEN 'image/png' WHEN path LIKE '%.csv' THEN 'text/csv' WHEN path LIKE '%.doc' THEN 'application/msword' WHEN path LIKE '%.webm' THEN 'video/webm'
                     WHEN path LIKE '%.html' THEN 'text/html' ELSE 'application/octet-stream' END AS mime FROM f
""")
def mime_guess(spark, sf_dir):
    ending = F.get(F.array(*map(F.lit, (".PNG", ".csv", ".unknown", "", ".PNG", ".doc", ".webm", ""))), (F.col("page_id") % 8).cast("int"))
    return _objects(spark, sf_dir).select(
        "page_id", scalars.mime_guess(F.concat("name", ending)).alias("mime"))


@query("prefix_normalize", """
SELECT page_id, regexp_replace(regexp_replace(url, '^[a-z]+:/', ''), '^/', '') AS prefix FROM pages
""")
def prefix_normalize(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", scalars.prefix_normalize(
        F.regexp_replace("url", "^[a-z]+:/", "")).alias("prefix"))


@query("split_object_url", f"""
SELECT page_id, bucket, name AS path FROM {INVENTORY}
UNION ALL SELECT page_id, bucket || '-plain', '' FROM {INVENTORY}
""")
def split_object_url(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    both = pages.select("page_id", "url").union(
        _objects(spark, sf_dir).select("page_id", F.concat("bucket", F.lit("-plain"))))
    return both.select("page_id", scalars.split_object_url(F.col("url")).alias("u")).select("page_id", "u.*")
