"""Registered queries: keyed writes, mapping tables, curation, sections and exports."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import dates, names, text
from ..operators import catalog, curation, keyed, records, resolve, writes
from ..operators import series as ts
from ..session import kept, scratch_folder
from ..sources import sinks
from . import tables as t
from .registry import REGISTRY

add = REGISTRY.add

STAMP = "2024-02-01T00:00:00Z"


def now():
    return F.lit(STAMP)


# --- keyed append, ignore, upsert -------------------------------------------------------------


def coded(spark, sf, code, **bounds):
    """Observations by month, series, unit, country and form with the number of rows behind them: the key of a stored row
    is a part of that, so whole groups are new or known.
    """
    obs = t.observation_totals(spark, sf, "month", "series", "form", **bounds)
    return obs.select(
        dates.month_text(F.col("month")).alias("date"), "series", F.lit(code).alias("hs_code"), "unit", "country", "form", "value", "n"
    )


CODED_SQL = """
SELECT strftime(month, '%Y-%m') AS date, series, unit, country, form, value FROM obs"""


@add("append_new", "K1 J1 F6 U4", f"""
WITH {t.OBS_SQL}, c AS ({CODED_SQL}), stored AS (SELECT DISTINCT date, series, unit, country FROM c WHERE date <= '1998-06' AND form <> 'other'),
new AS (SELECT * FROM c WHERE date >= '1998-01')
SELECT date, series, unit, country, form, count(*) AS n, sum(value)::DOUBLE AS value FROM new
WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.date = new.date AND s.series = new.series AND s.unit = new.unit AND s.country = new.country)
GROUP BY ALL""")
def append_new(spark, sf):
    stored = coded(spark, sf, "507.9", until="1998-07-01").filter("form <> 'other'")
    new = coded(spark, sf, "0507.90", since="1998-01-01")
    out = writes.append_new(new, stored, keys=writes.OBSERVATION_KEY)
    return out.groupBy("date", "series", "unit", "country", "form").agg(
        F.sum("n").alias("n"), F.sum("value").cast("double").alias("value")
    )


@add("append_one_series", "K2 P2", f"""
WITH {t.OBS_SQL}, c AS ({CODED_SQL}), stored AS (SELECT DISTINCT date, series, unit, country FROM c WHERE series = 'F' AND form = 'frozen')
SELECT date, series, unit, country, count(*) AS n FROM c
WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.date = c.date AND s.series = c.series AND s.unit = c.unit AND s.country = c.country)
GROUP BY ALL""")
def append_one_series(spark, sf):
    new = coded(spark, sf, "0507.90")
    stored = new.filter("form = 'frozen'")
    out = writes.append_new(new, stored, keys=writes.OBSERVATION_KEY, scope=F.col("series") == "F")
    return out.groupBy("date", "series", "unit", "country").agg(F.sum("n").alias("n"))


def record_rows(spark, sf):
    return t.import_records(spark, sf).select(
        "record_id",
        F.col("day").cast("string").alias("date"),
        F.col("importer_local").alias("importer_ko"),
        "product_name",
    )


@add("append_records", "K3 U4", f"""
WITH {t.REC_SQL}, stored AS (SELECT day, importer_local, product_name FROM rec WHERE day < DATE '1998-01-01'),
new AS (SELECT * FROM rec WHERE day >= DATE '1997-06-01')
SELECT record_id, day::VARCHAR AS date, importer_local AS importer_ko, product_name FROM new
WHERE (day, importer_local, product_name) NOT IN (SELECT * FROM stored)""")
def append_records(spark, sf):
    rows = record_rows(spark, sf)
    new, stored = rows.filter("date >= '1997-06-01'"), rows.filter("date < '1998-01-01'")
    return writes.append_new(new, stored, keys=writes.RECORD_KEY)


@add("append_prices", "K4", f"""
WITH {t.PRICE_SQL}, stored AS (SELECT DISTINCT year, rank, product_name FROM price WHERE year <= 2030)
SELECT year::INTEGER AS year, rank, product_name, price FROM price
WHERE (year, rank, product_name) NOT IN (SELECT * FROM stored)""")
def append_prices(spark, sf):
    p = t.prices(spark, sf)
    return writes.append_new(p, p.filter("year <= 2030"), keys=writes.PRICE_KEY).drop("origin")


@add("append_counts", "K1", """
SELECT (SELECT count(*) FROM events) AS offered,
       (SELECT count(*) FROM events WHERE event_type NOT IN (SELECT event_type FROM events WHERE user_id = 8)) AS appended,
       (SELECT count(*) FROM events WHERE event_type IN (SELECT event_type FROM events WHERE user_id = 8)) AS skipped""")
def append_counts(spark, sf):
    e = t.table(spark, sf, "events")
    return writes.append_counts(e, writes.append_new(e, e.filter("user_id = 8"), keys=["event_type"]))


@add("insert_or_ignore", "K5 D1 W4 U6", """
WITH b AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-10'), s AS (SELECT DISTINCT user_id, event_type FROM events WHERE ts < TIMESTAMP '2024-01-15' AND value > 40)
SELECT user_id, event_type, min(event_id) AS event_id, arg_min(value, event_id) AS value FROM b
WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.user_id = b.user_id AND s.event_type = b.event_type) GROUP BY ALL""")
def insert_or_ignore(spark, sf):
    e = t.table(spark, sf, "events")
    stored = e.filter("ts < timestamp'2024-01-15' and value > 40").select("user_id", "event_type")
    batch = e.filter("ts >= timestamp'2024-01-10'").select("user_id", "event_type", "event_id", "value")
    return writes.insert_or_ignore(batch, stored, keys=["user_id", "event_type"], order=[F.col("event_id")])


@add("exact_duplicates", "D1 F10 K5", """
SELECT substr(sha256('https://www.' || source || '.example.com/' || text), 1, 16) AS content_hash,
       min(doc_id) AS doc_id, arg_min(lang, doc_id) AS lang FROM documents GROUP BY 1""")
def exact_duplicates(spark, sf):
    url = F.concat(F.lit("https://www."), F.col("source"), F.lit(".example.com/"))
    d = t.table(spark, sf, "documents").select(text.content_hash(url, F.col("text")).alias("content_hash"), "doc_id", "lang")
    return keyed.pick_per_key(d, ["content_hash"], [F.col("doc_id")])


def upsert_inputs(spark, sf):
    c = t.table(spark, sf, "customer")
    target = c.filter("c_acctbal > 0").select(
        F.col("c_custkey").alias("ref"), F.col("c_name").alias("title"), F.col("c_mktsegment").alias("category"),
        F.lit("2023").alias("curated_at"),
    )
    updates = c.filter("c_nationkey < 12").select(
        F.col("c_custkey").alias("ref"), F.explode(F.array(F.lit(2), F.lit(1))).alias("version"), "c_name"
    ).select("ref", F.concat("c_name", F.lit(" v"), "version").alias("title"), F.lit("REVIEWED").alias("category"), "version")
    return writes.upsert(
        target, updates, keys=["ref"], update=["title", "category"], on_insert={"curated_at": F.lit("2024")},
        order=[F.col("version")],
    )


UPSERT_SQL = """
WITH o AS (SELECT c_custkey AS ref, c_name AS title, c_mktsegment AS category FROM customer WHERE c_acctbal > 0),
u AS (SELECT c_custkey AS ref, c_name || ' v2' AS title, 'REVIEWED' AS category FROM customer WHERE c_nationkey < 12),
j AS (SELECT ref, coalesce(u.title, o.title) AS title, coalesce(u.category, o.category) AS category,
             CASE WHEN o.title IS NULL THEN '2024' ELSE '2023' END AS curated_at,
             CASE WHEN o.title IS NULL THEN 'inserted' WHEN u.title IS NULL THEN 'kept' ELSE 'updated' END AS action
      FROM o FULL OUTER JOIN u USING (ref))"""


@add("upsert_rows", "K6", f"{UPSERT_SQL} SELECT ref, title, category, curated_at FROM j")
def upsert_rows(spark, sf):
    return upsert_inputs(spark, sf).rows


@add("upsert_counts", "K6", f"{UPSERT_SQL} SELECT action, count(*) AS n FROM j GROUP BY 1")
def upsert_counts(spark, sf):
    return upsert_inputs(spark, sf).counts


@add("promotion_conflicts", "K7", """
SELECT o.o_custkey AS ref, c.c_custkey + 1 AS doc_id,
       'ref ' || o.o_custkey || ' is already promoted, see row ' || (c.c_custkey + 1) AS message
FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 300000) o JOIN customer c ON c.c_custkey = o.o_custkey AND c.c_acctbal > 0""")
def promotion_conflicts(spark, sf):
    batch = t.table(spark, sf, "orders").filter("o_totalprice > 300000").select(F.col("o_custkey").alias("ref")).distinct()
    target = t.table(spark, sf, "customer").filter("c_acctbal > 0").select(
        F.col("c_custkey").alias("ref"), (F.col("c_custkey") + 1).alias("doc_id")
    )
    return writes.promotion_conflicts(batch, target, key="ref", target_id="doc_id")


@add("raw_copy", "K9 F30", f"WITH {t.REC_SQL} SELECT record_id, importer_local, '{STAMP}' AS ingested_at FROM rec")
def raw_copy(spark, sf):
    return writes.raw_copy(t.import_records(spark, sf), ["record_id", "importer_local"], now())


@add("constraint_violations", "K5 K7", "SELECT text, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1")
def constraint_violations(spark, sf):
    return writes.constraint_violations(t.table(spark, sf, "documents"), unique=["text"])


# --- mapping tables -----------------------------------------------------------------------------

KEY_SQL = "regexp_replace(replace(replace(replace(replace(replace(replace(replace(upper(trim({c})), 'LTD.', ''), 'LTD', ''), 'CO.', ''), 'CO', ''), 'LIMITED', ''), 'INC.', ''), 'INC', ''), '[^\\p{{L}}\\p{{N}}_]', '', 'g')"


def key_sql(c):
    return KEY_SQL.format(c=c)


@add("entity_keys", "F13", f"WITH {t.REC_SQL} SELECT DISTINCT importer_local, {key_sql('importer_local')} AS match_key FROM rec")
def entity_keys(spark, sf):
    rows = t.import_records(spark, sf).select("importer_local").distinct()
    return rows.withColumn("match_key", names.entity_key(F.col("importer_local")))


def supplier_mapping(spark, sf):
    """Customers seen by a supplier-sized list: later rows win, some names stay blank."""
    c = t.table(spark, sf, "customer")
    return resolve.build_mapping(
        c.select(
            F.col("c_name").alias("source"),
            F.when(F.col("c_nationkey") == 3, "").otherwise(F.concat(F.lit("Importer "), F.col("c_custkey").cast("string"))).alias("canonical"),
            "c_custkey",
            "c_nationkey",
        ).filter("c_nationkey <> 5"),
        source="source",
        canonical="canonical",
        order=[F.col("c_custkey")],
    )


MAP_SQL = f"""
cmap AS (SELECT {key_sql('c_name')} AS match_key,
  arg_max(CASE WHEN c_nationkey = 3 THEN '' ELSE 'Importer ' || c_custkey END, c_custkey) AS canonical
  FROM customer WHERE c_nationkey <> 5 GROUP BY 1)"""

TERM_SQL = f"""
tmap AS (SELECT {key_sql('n_name')} AS match_key, arg_max('Country ' || n_nationkey, n_nationkey) AS canonical
  FROM nation WHERE n_regionkey <> 4 GROUP BY 1)"""


def country_mapping(spark, sf):
    n = t.table(spark, sf, "nation").filter("n_regionkey <> 4")
    return resolve.build_mapping(
        n.withColumn("canonical", F.concat(F.lit("Country "), F.col("n_nationkey").cast("string"))),
        source="n_name",
        canonical="canonical",
        order=[F.col("n_nationkey")],
    )


@add("mapping_table", "J5", f"WITH {MAP_SQL} SELECT * FROM cmap")
def mapping_table(spark, sf):
    return supplier_mapping(spark, sf)


def resolved(spark, sf):
    gates = [
        resolve.Gate("importer_local", "importer_en", supplier_mapping(spark, sf), "map_companies"),
        resolve.Gate("origin_local", "origin_en", country_mapping(spark, sf), "map_countries"),
        resolve.Gate("product_name", "product_en", None, "map_types"),
    ]
    return resolve.resolve_terms(
        t.import_records(spark, sf), gates, row_ref="record_id", table_name="import_records", flagged_at=now()
    )


RESOLVED_SQL = f"""
{t.REC_SQL}, {MAP_SQL}, {TERM_SQL}, j AS (
  SELECT rec.*, {key_sql('importer_local')} AS k1, {key_sql('origin_local')} AS k2, cmap.canonical AS c1, cmap.match_key AS m1, tmap.canonical AS c2, tmap.match_key AS m2
  FROM rec LEFT JOIN cmap ON cmap.match_key = {key_sql('importer_local')} LEFT JOIN tmap ON tmap.match_key = {key_sql('origin_local')})"""


@add("resolved_rows", "J6 K3", f"""
WITH {RESOLVED_SQL}
SELECT record_id, coalesce(nullif(trim(importer_en), ''), nullif(c1, '')) AS importer_en,
       coalesce(nullif(trim(origin_en), ''), nullif(c2, '')) AS origin_en, product_en FROM j""")
def resolved_rows(spark, sf):
    return resolved(spark, sf).rows.select("record_id", "importer_en", "origin_en", "product_en")


@add("resolve_exceptions", "J6 K3 K8", f"""
WITH {RESOLVED_SQL}
SELECT 'import_records' AS source_table, record_id::VARCHAR AS row_ref, 'importer_en' AS field, importer_local AS raw_value, k1 AS match_key,
       CASE WHEN m1 IS NULL THEN 'no map_companies match' ELSE 'blank_mapping in map_companies' END AS reason, '{STAMP}' AS flagged_at
FROM j WHERE trim(importer_en) = '' AND nullif(c1, '') IS NULL
UNION ALL
SELECT 'import_records', record_id::VARCHAR, 'origin_en', origin_local, k2,
       CASE WHEN m2 IS NULL THEN 'no map_countries match' ELSE 'blank_mapping in map_countries' END, '{STAMP}'
FROM j WHERE trim(origin_en) = '' AND nullif(c2, '') IS NULL""")
def resolve_exceptions(spark, sf):
    return resolved(spark, sf).exceptions


# --- import records as one job -------------------------------------------------------------------


def ingested_records(spark, sf):
    """Two overlapping files of import records and the second one again, each appended, resolved, copied and flagged."""
    rec = t.import_records(spark, sf).select(
        "*", F.col("day").cast("string").alias("date"), F.col("importer_local").alias("importer_ko")
    )
    # Each file meets the mapping again: it is built once.
    companies = kept(supplier_mapping(spark, sf), "map_companies")
    gates = [
        resolve.Gate("importer_local", "importer_en", companies, "map_companies"),
        resolve.Gate("origin_local", "origin_en", country_mapping(spark, sf), "map_countries"),
        resolve.Gate("product_name", "product_en", None, "map_types"),
    ]
    store = records.RecordStore(
        spark, f"{scratch_folder(spark)}/records-{uuid.uuid4().hex}", rec.schema, keys=writes.RECORD_KEY,
        raw=["date", "importer_ko", "product_name", "origin_local"], row_ref="record_id", name="import_records",
    )
    first, second = rec.filter("day < date'1998-01-01'"), rec.filter("day >= date'1997-06-01'")
    since = F.col("day") >= F.lit("1997-06-01").cast("date")
    counts = [store.ingest(batch, gates, now=now(), scope=scope) for batch, scope in ((first, None), (second, since), (second, since))]
    return store, counts


INGESTED_SQL = f"""
{RESOLVED_SQL}, kept AS (
  SELECT * FROM j WHERE day < DATE '1998-01-01'
  UNION ALL
  SELECT * FROM j WHERE day >= DATE '1998-01-01' OR (day >= DATE '1997-06-01' AND (day, importer_local, product_name) NOT IN (
    SELECT day, importer_local, product_name FROM rec WHERE day < DATE '1998-01-01')))"""


@add("ingested_records", "K3 K1", f"""
WITH {INGESTED_SQL}
SELECT record_id, day::VARCHAR AS date, importer_local AS importer_ko, product_name, coalesce(nullif(trim(importer_en), ''), nullif(c1, '')) AS importer_en,
       coalesce(nullif(trim(origin_en), ''), nullif(c2, '')) AS origin_en FROM kept""")
def ingested_records_rows(spark, sf):
    store, _ = ingested_records(spark, sf)
    return store.read("records").select("record_id", "date", "importer_ko", "product_name", "importer_en", "origin_en")


@add("ingested_raw", "K3 K9", f"""
WITH {INGESTED_SQL} SELECT day::VARCHAR AS date, importer_local AS importer_ko, product_name, origin_local, '{STAMP}' AS ingested_at FROM kept""")
def ingested_raw(spark, sf):
    return ingested_records(spark, sf)[0].read("raw")


@add("ingested_exceptions", "K3 J6", f"""
WITH {INGESTED_SQL}
SELECT 'import_records' AS source_table, record_id::VARCHAR AS row_ref, 'importer_en' AS field, importer_local AS raw_value, k1 AS match_key,
       CASE WHEN m1 IS NULL THEN 'no map_companies match' ELSE 'blank_mapping in map_companies' END AS reason, '{STAMP}' AS flagged_at
FROM kept WHERE trim(importer_en) = '' AND nullif(c1, '') IS NULL
UNION ALL
SELECT 'import_records', record_id::VARCHAR, 'origin_en', origin_local, k2,
       CASE WHEN m2 IS NULL THEN 'no map_countries match' ELSE 'blank_mapping in map_countries' END, '{STAMP}'
FROM kept WHERE trim(origin_en) = '' AND nullif(c2, '') IS NULL""")
def ingested_exceptions(spark, sf):
    """Each unresolved name of a stored row once, however often its file comes."""
    return ingested_records(spark, sf)[0].read("exceptions")


@add("ingested_counts", "K3", f"""
WITH {INGESTED_SQL}, n AS (SELECT count(*) FILTER (WHERE day < DATE '1998-01-01') AS first, count(*) FILTER (WHERE day >= DATE '1997-06-01') AS second, count(*) AS every FROM rec),
k AS (SELECT count(*) AS stored FROM kept)
SELECT 1 AS run, first AS parsed, first AS written, 0 AS skipped FROM n
UNION ALL SELECT 2, second, stored - first, second - (stored - first) FROM n, k
UNION ALL SELECT 3, second, 0, second FROM n""")
def ingested_counts(spark, sf):
    _, counts = ingested_records(spark, sf)
    return spark.createDataFrame([(i + 1, c.parsed, c.written, c.skipped) for i, c in enumerate(counts)], "run int, parsed bigint, written bigint, skipped bigint")


SEED_SQL = """
votes AS (
  SELECT {key} AS match_key, local, name, seq FROM ({src}) WHERE {key} <> ''
), n AS (SELECT match_key, name, count(*) AS n, min(seq) AS first FROM votes WHERE name <> '' GROUP BY ALL
), f AS (SELECT match_key, arg_min(local, seq) AS source_name FROM votes GROUP BY 1)
SELECT match_key, source_name, name AS canonical FROM n JOIN f USING (match_key)
QUALIFY row_number() OVER (PARTITION BY match_key ORDER BY n DESC, first) = 1"""


@add("majority_mapping", "A18", "WITH " + SEED_SQL.format(
    key=key_sql("local"),
    src="SELECT o_orderpriority AS local, CASE WHEN o_orderstatus = 'P' THEN '' ELSE c_mktsegment END AS name, o_orderkey AS seq "
        "FROM orders JOIN customer ON o_custkey = c_custkey"))
def majority_mapping(spark, sf):
    o, c = t.table(spark, sf, "orders"), t.table(spark, sf, "customer")
    rows = o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderpriority").alias("local"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("c_mktsegment")).alias("name"),
        F.col("o_orderkey").alias("seq"),
    )
    return resolve.seed_mapping(rows, pairs=[("local", "name")], order=[F.col("seq")])


@add("majority_mapping_pairs", "A18 U5", f"WITH {t.REC_SQL}, " + SEED_SQL.format(
    key=key_sql("local"),
    src="SELECT origin_local AS local, origin_en AS name, record_id * 2 AS seq FROM rec UNION ALL "
        "SELECT importer_local, importer_en, record_id * 2 + 1 FROM rec"))
def majority_mapping_pairs(spark, sf):
    return resolve.seed_mapping(
        t.import_records(spark, sf),
        pairs=[("origin_local", "origin_en"), ("importer_local", "importer_en")],
        order=[F.col("record_id")],
    )


@add("fill_blank", "K8", f"""
WITH {t.REC_SQL}, v AS (SELECT record_id, 'filled ' || origin_local AS p FROM rec WHERE quantity > 100000)
SELECT record_id, coalesce(nullif(trim(product_en), ''), v.p) AS product_en, origin_local FROM rec LEFT JOIN v USING (record_id)""")
def fill_blank(spark, sf):
    rec = t.import_records(spark, sf).select("record_id", "product_en", "origin_local", "quantity")
    values = rec.filter("quantity > 100000").select("record_id", "origin_local", F.explode(F.array(F.lit("filled "), F.lit("again "))).alias("p"))
    values = values.select("record_id", F.concat("p", "origin_local").alias("product_en"), (F.col("p") == "again ").alias("later"))
    return resolve.fill_blank(rec.drop("quantity"), values, keys=["record_id"], columns=["product_en"], order=[F.col("later")])


FLAGS = {"importer_en": "importer_en", "product_en": "product_en", "origin_en": "country_origin_en"}
FLAG_SQL = "concat_ws('; ', " + ", ".join(
    f"CASE WHEN trim({c}) = '' THEN '{label} missing' END" for c, label in FLAGS.items()) + ")"


@add("missing_flags", "P16", f"WITH {t.REC_SQL} SELECT record_id, {FLAG_SQL} AS flags FROM rec")
def missing_flags(spark, sf):
    return t.import_records(spark, sf).select("record_id", resolve.missing_flags(FLAGS).alias("flags"))


@add("review_view", "T4 K15 P16", f"""
WITH {t.REC_SQL}
SELECT record_id, day, importer_local, importer_en, {FLAG_SQL} AS flags FROM rec ORDER BY day DESC, record_id LIMIT 50""")
def review_view(spark, sf):
    recent = keyed.top_k(t.import_records(spark, sf), [F.col("day").desc(), F.col("record_id")], 50)
    return recent.select("record_id", "day", "importer_local", "importer_en", resolve.missing_flags(FLAGS).alias("flags"))


@add("display_records", "P15 F14", f"""
WITH {t.REC_SQL}
SELECT record_id, coalesce(nullif(trim(origin_en), ''), '—') AS origin,
       CASE coalesce(nullif(trim(importer_en), ''), nullif(trim(importer_local), ''), '—')
         WHEN 'CUSTOMER#000000001' THEN 'First importer' ELSE coalesce(nullif(trim(importer_en), ''), nullif(trim(importer_local), ''), '—') END AS importer,
       coalesce(nullif(trim(product_en), ''), nullif(trim(product_name), ''), '—') AS product,
       day >= DATE '2001-09-15' - 90 AS in_last_90d FROM rec""")
def display_records(spark, sf):
    return sinks.display_records(
        t.import_records(spark, sf),
        chains={
            "origin": ["origin_en"],
            "importer": ["importer_en", "importer_local"],
            "product": ["product_en", "product_name"],
        },
        aliases={"importer": {"CUSTOMER#000000001": "First importer"}},
        day="day",
        as_of=F.lit("2001-09-15").cast("date"),
    ).select("record_id", "origin", "importer", "product", "in_last_90d")


# --- queues, judgements, curation ----------------------------------------------------------------


@add("pending_articles", "J2", "SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def pending_articles(spark, sf):
    d = t.table(spark, sf, "documents").select("doc_id", "lang", "source")
    lab = t.table(spark, sf, "labels").select(F.col("doc_id").alias("raw_ref"))
    return writes.pending(d, lab, raw_id="doc_id", ref="raw_ref")


@add("first_pending", "T8 J2", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY doc_id LIMIT 100")
def first_pending(spark, sf):
    return writes.first_pending(pending_articles(spark, sf).select("doc_id"), order="doc_id", n=100)


@add("judged_rows", "K17", f"""
WITH {t.ART_SQL}
SELECT raw_ref, coalesce(relevant, false) AS relevant, '{STAMP}' AS relevance_judged_at, CASE WHEN relevant THEN lang END AS category,
       CASE WHEN relevant THEN source END AS english_title, CASE WHEN relevant THEN '{STAMP}' END AS classified_at
FROM art WHERE judged""")
def judged_rows(spark, sf):
    a = t.document_articles(spark, sf).filter("judged")
    rows = a.select("raw_ref", "relevant", F.col("lang").alias("category"), F.col("source").alias("english_title"))
    return writes.judged_rows(rows, ref="raw_ref", relevant="relevant", fields=["category", "english_title"], now=now())


def stuck_inputs(spark, sf):
    a = t.document_articles(spark, sf).filter("judged")
    canonical = a.select(
        "raw_ref",
        "relevant",
        F.when(F.col("source") != "src3", F.col("lang")).alias("category"),
        F.when(F.col("source") != "src3", F.lit("2024-01-01")).alias("classified_at"),
    )
    answers = a.filter("lang <> 'de'").select("raw_ref", "lang", F.explode(F.array(F.lit("later "), F.lit("fixed "))).alias("p"))
    answers = answers.select("raw_ref", F.concat("p", "lang").alias("category"), (F.col("p") == "later ").alias("later"))
    return canonical, answers


@add("stuck_rows", "K18", f"WITH {t.ART_SQL} SELECT raw_ref FROM art WHERE judged AND relevant AND source = 'src3'")
def stuck_rows(spark, sf):
    return writes.stuck_rows(stuck_inputs(spark, sf)[0]).select("raw_ref")


@add("repair_stuck", "K18", f"""
WITH {t.ART_SQL}
SELECT raw_ref, relevant,
       CASE WHEN source <> 'src3' THEN lang WHEN relevant AND lang <> 'de' THEN 'fixed ' || lang END AS category,
       CASE WHEN source <> 'src3' THEN '2024-01-01' WHEN relevant AND lang <> 'de' THEN '{STAMP}' END AS classified_at
FROM art WHERE judged""")
def repair_stuck(spark, sf):
    canonical, answers = stuck_inputs(spark, sf)
    return writes.repair_stuck(canonical, answers, ref="raw_ref", fields=["category"], now=now(), order=[F.col("later")])


def curation_table(spark, sf):
    """Reviewer rows from the labels: keys as spreadsheets return them, some blank, some unknown."""
    lab = t.table(spark, sf, "labels")
    key = F.when(F.col("quality") == 0, F.concat(F.col("doc_id").cast("string"), F.lit(".0"))).otherwise(F.col("doc_id").cast("string"))
    return lab.select(
        F.when((F.col("toxic") == 1) & (F.col("quality") == 0), "").otherwise(key).alias("raw_ref"),
        F.when(F.col("toxic") == 1, " yes ").otherwise("no").alias("hidden"),
        F.when(F.col("quality") == 1, "TRUE").otherwise("").alias("manual_override"),
        F.col("doc_id").alias("line_no"),
    )


def canonical_articles(spark, sf):
    return t.document_articles(spark, sf).filter("lang <> 'fr'").select(
        "raw_ref", "lang", F.lit(False).alias("hidden"), F.lit(False).alias("manual_override")
    )


CUR_SQL = """
cur AS (SELECT doc_id, CASE WHEN toxic = 1 AND quality = 0 THEN NULL ELSE doc_id END AS k, toxic = 1 AS hidden, quality = 1 AS ov FROM labels),
can AS (SELECT doc_id AS raw_ref, lang FROM documents WHERE lang <> 'fr')"""


@add("curation_pushed", "J14", f"""
WITH {CUR_SQL}
SELECT raw_ref, lang, '' AS hidden, '' AS manual_override FROM can WHERE raw_ref NOT IN (SELECT k FROM cur WHERE k IS NOT NULL)""")
def curation_pushed(spark, sf):
    cand = canonical_articles(spark, sf).select("raw_ref", "lang")
    return curation.push_rows(cand, curation_table(spark, sf), key="raw_ref", blanks=["hidden", "manual_override"], numeric=True)


@add("curation_flags", "J15 F12", f"""
WITH {CUR_SQL}
SELECT raw_ref, lang, coalesce(cur.hidden, false) AS hidden, coalesce(cur.ov, false) AS manual_override FROM can LEFT JOIN cur ON cur.k = can.raw_ref""")
def curation_flags(spark, sf):
    return pulled(spark, sf).rows


@add("curation_flag_counts", "J15", f"""
WITH {CUR_SQL}
SELECT CASE WHEN k IS NULL THEN 'skipped_blank_key' WHEN raw_ref IS NULL THEN 'skipped_no_match' ELSE 'applied' END AS outcome, count(*) AS n
FROM cur LEFT JOIN can ON cur.k = can.raw_ref GROUP BY 1""")
def curation_flag_counts(spark, sf):
    return pulled(spark, sf).counts


def pulled(spark, sf):
    return curation.pull_flags(
        canonical_articles(spark, sf),
        curation_table(spark, sf),
        key="raw_ref",
        flags=["hidden", "manual_override"],
        order=[F.col("line_no")],
    )


@add("curation_documents", "J15 K6", """
WITH docs AS (SELECT p_partkey AS file_ref, p_name AS title, p_brand AS category FROM part WHERE p_size > 25),
cur AS (SELECT ps AS file_ref, title, category FROM (SELECT p_partkey AS ps, 'Titled ' || p_name AS title, nullif(p_type, 'SMALL') AS category FROM part WHERE p_brand <> 'Brand#1'))
SELECT file_ref, CASE WHEN cur.title IS NOT NULL THEN cur.title ELSE docs.title END AS title,
       CASE WHEN cur.title IS NOT NULL THEN cur.category ELSE docs.category END AS category,
       CASE WHEN docs.title IS NULL THEN '2024' ELSE '2020' END AS curated_at,
       CASE WHEN docs.title IS NULL THEN 'reviewer' ELSE 'first' END AS curated_by
FROM docs FULL OUTER JOIN cur USING (file_ref)""")
def curation_documents(spark, sf):
    p = t.table(spark, sf, "part")
    docs = p.filter("p_size > 25").select(
        F.col("p_partkey").alias("file_ref"), F.col("p_name").alias("title"), F.col("p_brand").alias("category"),
        F.lit("2020").alias("curated_at"), F.lit("first").alias("curated_by"),
    )
    files = p.select(F.concat(F.lit("file-"), F.col("p_partkey").cast("string")).alias("file_key"), F.col("p_partkey").alias("file_id"))
    cur = p.select(
        F.concat(F.lit(" file-"), F.col("p_partkey").cast("string")).alias("file_key"),
        F.when(F.col("p_brand") == "Brand#1", " ").otherwise(F.concat(F.lit("Titled "), F.col("p_name"))).alias("title"),
        F.when(F.col("p_type") == "SMALL", "").otherwise(F.col("p_type")).alias("category"),
        F.col("p_partkey").alias("line_no"),
    )
    return curation.pull_documents(
        docs, files, cur, file_key="file_key", file_id="file_id", ref="file_ref", title="title", fields=["category"],
        now=F.lit("2024"), by=F.lit("reviewer"), order=[F.col("line_no")],
    ).rows


def weekly(spark, sf):
    """Order days as weeks: drafts, approved briefs and the reviewers' table."""
    days = t.table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderpriority").alias("p"), F.min("o_orderstatus").alias("s")
    )
    week = F.col("day").cast("string").alias("week")
    draft_id = F.datediff("day", F.lit("1990-01-01").cast("date")).cast("bigint").alias("draft_id")
    drafts = days.filter("n > 3").select(
        draft_id, week, F.concat(F.lit("draft "), F.col("n").cast("string")).alias("draft_text"), F.lit("ok").alias("fact_check_status")
    )
    cur = days.select(
        week,
        F.when(F.col("n") % 2 == 0, "yes").otherwise("").alias("approved"),
        F.lit(" ").alias("approved_at"),
        F.when(F.col("n") == 8, F.col("p")).otherwise("").alias("published_text"),
        F.col("s").alias("notes"),
        F.concat(F.lit("draft "), F.col("n").cast("string")).alias("draft_text"),
        F.lit("").alias("fact_check_status"),
    )
    briefs = days.filter("n > 5").select(
        draft_id,
        F.lit(False).alias("approved"),
        F.lit(None).cast("string").alias("approved_at"),
        F.lit(None).cast("string").alias("published_text"),
        F.lit("old").alias("notes"),
    )
    return drafts, briefs, cur


DAYS_SQL = """
days AS (SELECT o_orderdate::DATE AS day, count(*) AS n, min(o_orderpriority) AS p, min(o_orderstatus) AS s FROM orders GROUP BY 1),
synced AS (SELECT (day - DATE '1990-01-01')::BIGINT AS draft_id, n % 2 = 0 AS approved, CASE WHEN n % 2 = 0 THEN day::VARCHAR END AS approved_at,
                  CASE WHEN n = 8 THEN p END AS published_text, s AS notes, day, n FROM days WHERE n > 3)"""


@add("approvals_synced", "J16 K6", f"WITH {DAYS_SQL} SELECT draft_id, approved, approved_at, published_text, notes FROM synced")
def approvals_synced(spark, sf):
    drafts, briefs, cur = weekly(spark, sf)
    return curation.sync_approvals(briefs, drafts, cur, order=[F.col("week")]).rows


@add("latest_approved", "J4 Z7", f"""
WITH {DAYS_SQL}
SELECT day::VARCHAR AS week, coalesce(published_text, 'draft ' || n) AS text, day::VARCHAR AS approved_at, 'ok' AS fact_check_status,
       (DATE '2001-09-15' - day)::INTEGER AS age_days, (DATE '2001-09-15' - day) > 14 AS is_stale
FROM synced WHERE approved ORDER BY day DESC LIMIT 1""")
def latest_approved(spark, sf):
    drafts, briefs, cur = weekly(spark, sf)
    synced = curation.sync_approvals(briefs, drafts, cur, order=[F.col("week")]).rows
    return curation.latest_approved(synced, drafts, as_of=F.lit("2001-09-15").cast("date"))


@add("drafts_rehydrated", "K19", f"""
WITH {DAYS_SQL} SELECT day::VARCHAR AS week, 'draft ' || n AS draft_text, 'ok' AS fact_check_status, '{STAMP}' AS generated_at FROM days WHERE n <= 3""")
def drafts_rehydrated(spark, sf):
    drafts, _, cur = weekly(spark, sf)
    # Every week twice; the later row comes first by its text.
    cur = cur.withColumn("line", F.explode(F.array(F.lit(2), F.lit(1))))
    cur = cur.withColumn("draft_text", F.when(F.col("line") == 2, F.lit("another")).otherwise(F.col("draft_text")))
    return curation.rehydrate(
        drafts, cur, week="week", text="draft_text", status="fact_check_status", now=now(), order=[F.col("line")]
    )


@add("drafts_pushed", "K19", f"WITH {DAYS_SQL} SELECT day::VARCHAR AS week, 'draft ' || n AS draft_text, '' AS approved FROM days WHERE n > 3 AND NOT (n % 2 = 0)")
def drafts_pushed(spark, sf):
    drafts, _, cur = weekly(spark, sf)
    listed = cur.filter("approved = 'yes'")
    return curation.push_rows(drafts.select("week", "draft_text"), listed, key="week", blanks=["approved"])


# --- sections and exports ------------------------------------------------------------------------

SOURCES = [
    catalog.Source("finished", "lineitem", "trade", "F"),
    catalog.Source("open", "lineitem", "trade", "O", enabled=False),
    catalog.Source("orders", "orders", "records"),
    catalog.Source("absent", "no_such_table", "records"),
]


def sections(spark, sf):
    tables = catalog.load_tables(
        spark, {n: f"{sf}/{n}.parquet" for n in ("lineitem", "orders", "no_such_table")}, SOURCES, {"no_such_table": catalog.IMPORT_RECORDS}
    )
    return tables, {s: catalog.section_rows(tables, SOURCES, s, series="l_linestatus") for s in ("trade", "records")}


@add("section_rows", "S16 S17 U1 P2", "SELECT l_orderkey, l_linenumber, l_linestatus, l_quantity FROM lineitem WHERE l_linestatus = 'F'")
def section_rows(spark, sf):
    return sections(spark, sf)[1]["trade"].select("l_orderkey", "l_linenumber", "l_linestatus", "l_quantity")


@add("section_status", "S17 S24 A20 A21", """
SELECT 'trade' AS section, count(*) AS n_rows, strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') AS last_updated, count(*) > 0 AS has_data FROM lineitem WHERE l_linestatus = 'F'
UNION ALL SELECT 'records', count(*), strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S'), count(*) > 0 FROM orders""")
def section_status(spark, sf):
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    rows = sections(spark, sf)[1]
    return catalog.section_status(
        {
            "trade": rows["trade"].select(stamp("l_shipdate").alias("date")),
            "records": rows["records"].select(stamp("o_orderdate").alias("date")),
        }
    )


@add("unassigned_series", "S17 D8", "SELECT l_linestatus AS series, count(*) AS n_rows FROM lineitem WHERE l_linestatus <> 'F' GROUP BY 1")
def unassigned_series(spark, sf):
    rows = t.table(spark, sf, "lineitem").select(F.col("l_linestatus").alias("series"))
    return catalog.unassigned_series(rows, SOURCES, "lineitem")


@add("code_split", "P4", """
SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN '0510.00' WHEN 'R' THEN '507.9' ELSE '0507.90' END AS hs_code,
       l_returnflag <> 'A' AS first_group FROM lineitem""")
def code_split(spark, sf):
    li = t.table(spark, sf, "lineitem")
    code = F.when(F.col("l_returnflag") == "A", "0510.00").when(F.col("l_returnflag") == "R", "507.9").otherwise("0507.90")
    rows = li.select("l_orderkey", "l_linenumber", code.alias("hs_code"))
    parts = catalog.split_by_code(rows, {"a": "507", "b": "510"})
    return parts["a"].withColumn("first_group", F.lit(True)).unionByName(parts["b"].withColumn("first_group", F.lit(False)))


@add("conformed_rows", "P13 D8", """
SELECT strftime(l_shipdate, '%Y-%m') AS date, l_linestatus AS series, NULL::VARCHAR AS hs_code, NULL::VARCHAR AS hs_label,
       CAST(l_quantity::BIGINT AS VARCHAR) AS value, NULL::VARCHAR AS unit, NULL::VARCHAR AS country, NULL::VARCHAR AS notes,
       NULL::VARCHAR AS hs_code_10digit, NULL::VARCHAR AS product_type FROM lineitem""")
def conformed_rows(spark, sf):
    li = t.table(spark, sf, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM").alias("date"), F.col("l_linestatus").alias("series"),
        F.col("l_quantity").cast("bigint").alias("value"), "l_tax",
    )
    return catalog.conform(li, catalog.OBSERVATIONS)


DECLARED_EVENTS = "event_id bigint, ts string, user_id int, session string, event_type string"


@add("schema_drift", "D8", """
SELECT * FROM (SELECT 'ts' AS "column", 'type' AS issue, 'string' AS expected, 'timestamp_ntz' AS live, count(ts) AS n_filled FROM events
UNION ALL SELECT 'user_id', 'type', 'int', 'bigint', count(user_id) FROM events
UNION ALL SELECT 'session', 'missing', 'string', '', 0
UNION ALL SELECT 'event_type', 'position', 'string', 'string', count(event_type) FROM events
UNION ALL SELECT 'value', 'unexpected', '', 'double', count(value) FROM events
UNION ALL SELECT 'props', 'unexpected', '', 'string', count(props) FROM events)""")
def schema_drift(spark, sf):
    """Differences between the events as they are and a declared header, with the number of values each one concerns."""
    return catalog.schema_drift(spark, t.table(spark, sf, "events"), StructType.fromDDL(DECLARED_EVENTS))


@add("price_rows", "S17 F3", "SELECT p_partkey, CASE WHEN p_size = 7 THEN 0 ELSE trunc(p_retailprice)::BIGINT END AS price_krw FROM part")
def price_rows(spark, sf):
    p = t.table(spark, sf, "part").select(
        "p_partkey",
        F.when(F.col("p_size") == 7, "n/a").otherwise(F.format_number(F.floor("p_retailprice"), 0)).alias("price_krw"),
    )
    return catalog.price_rows(p)


@add("export_trade_rows", "K11 F1", f"""
WITH {t.OBS_SQL}
SELECT strftime(month, '%Y-%m') AS date, series, unit, country, value::VARCHAR AS value FROM obs""")
def export_trade_rows(spark, sf):
    month = F.concat(F.year("month").cast("string"), F.lit("-"), F.month("month").cast("string"))
    rows = t.observations(spark, sf).withColumn("date", month)
    return sinks.trade_rows(rows, ["date", "series", "unit", "country", "value"])


@add("export_record_rows", "K12 F14", f"""
WITH {t.REC_SQL}
SELECT record_id, CASE importer_local WHEN 'Customer#000000001 Co., Ltd.' THEN 'First importer' ELSE importer_local END AS importer,
       CASE importer_en WHEN 'CUSTOMER#000000001' THEN 'First importer' ELSE importer_en END AS importer_en,
       coalesce(nullif(trim(product_en), ''), product_name) AS product_en FROM rec""")
def export_record_rows(spark, sf):
    alias = {"CUSTOMER#000000001": "First importer", "Customer#000000001 Co., Ltd.": "First importer"}
    return sinks.record_rows(
        t.import_records(spark, sf).withColumn("importer", F.lit("")),
        columns=["record_id", "importer", "importer_en", "product_en"],
        importer=["importer", "importer_local"],
        product=["product_en", "product_name"],
        aliases=alias,
    )


@add("export_news_rows", "K13 P18 F12", f"""
WITH {t.ART_SQL}
SELECT raw_ref, url FROM art WHERE relevant AND (trim(title) <> '' OR trim(url) <> '')""")
def export_news_rows(spark, sf):
    a = t.document_articles(spark, sf).withColumn("flag", F.when(F.col("relevant"), " True ").otherwise("0"))
    return sinks.news_rows(a, flag="flag", content=["title", "url"], columns=["raw_ref", "url"])


@add("export_trailing_rows", "K16 P6", f"""
WITH {t.REC_SQL} SELECT record_id, day::VARCHAR AS day, importer_local FROM rec WHERE day >= DATE '2001-09-15' - 90""")
def export_trailing_rows(spark, sf):
    rec = t.import_records(spark, sf).withColumn("day", F.col("day").cast("string"))
    rows = ts.trailing_days(rec, day="day", as_of=F.lit("2001-09-15").cast("date"), days=90)
    return rows.select("record_id", "day", "importer_local")


@add("library_documents", "S23 F17 S24", """
SELECT page_id AS id, url AS title, CASE WHEN url LIKE 'https:%' THEN url ELSE NULL END AS download_url,
       (DATE '2024-01-01' + page_id::INTEGER)::DATE::VARCHAR AS doc_date FROM pages ORDER BY doc_date DESC, id""")
def library_documents(spark, sf):
    p = t.table(spark, sf, "pages")
    docs = p.select(
        F.col("page_id").alias("id"),
        F.col("url").alias("title"),
        F.when(F.col("url").startswith("https:"), F.concat(F.lit(" "), F.col("url"))).otherwise(F.regexp_replace("url", "^http:", "ftp:")).alias("download_url"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("page_id").cast("int")).cast("string").alias("doc_date"),
    )
    return catalog.documents_listing(docs)


@add("availability", "A21 S24", """
SELECT source, count(*) FILTER (WHERE quality = 1) > 0 AS available FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""")
def availability(spark, sf):
    a = t.document_articles(spark, sf)
    return a.groupBy("source").agg(F.coalesce(F.bool_or("relevant"), F.lit(False)).alias("available"))


# --- whole exports and seeds ---------------------------------------------------------------------

EXPORTED = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@add("export_all_tables", "K14", " UNION ALL ".join(
    f"SELECT '{n}' AS \"table\", count(*) AS n_rows, count(*) AS n_read FROM {n}" for n in EXPORTED))
def export_all_tables(spark, sf):
    """Every table written as CSV with its count, and counted again from what was written."""
    root = f"{scratch_folder(spark)}/export-{uuid.uuid4().hex}"
    written = sinks.export_all({n: t.table(spark, sf, n) for n in EXPORTED}, root)
    again = None
    for n in EXPORTED:
        one = sinks.read_csv(spark, f"{root}/{n}").agg(F.count(F.lit(1)).alias("n_read")).withColumn("table", F.lit(n))
        again = one if again is None else again.unionByName(one)
    return written.join(again, "table")


@add("export_round_trip", "K14", """
SELECT doc_id::VARCHAR AS id, 'documents' AS "table", md5(coalesce(text, '') || '|' || coalesce(lang, '')) AS content FROM documents
UNION ALL SELECT conv_id::VARCHAR || ':' || turn, 'conversations', md5(coalesce(role, '') || '|' || coalesce(text, '')) FROM conversations
UNION ALL SELECT vec_id::VARCHAR, 'embeddings', len(embedding)::VARCHAR || '|' || coalesce(label::VARCHAR, '') FROM embeddings""")
def export_round_trip(spark, sf):
    """What the CSV files of the text and array tables hold, read again: quotes, line ends, blanks and arrays as JSON."""
    root = f"{scratch_folder(spark)}/export-{uuid.uuid4().hex}"
    names_ = ("documents", "conversations", "embeddings")
    sinks.export_all({n: t.table(spark, sf, n) for n in names_}, root)
    d, c, e = (sinks.read_csv(spark, f"{root}/{n}") for n in names_)
    full = lambda x: F.coalesce(x, F.lit(""))
    row = lambda key, n, content: (key.alias("id"), F.lit(n).alias("table"), content.alias("content"))
    size = F.size(F.from_json("embedding", "array<float>")).cast("string")
    return (
        d.select(*row(F.col("doc_id"), "documents", F.md5(F.concat(full(F.col("text")), F.lit("|"), full(F.col("lang"))))))
        .unionByName(c.select(*row(F.concat_ws(":", "conv_id", "turn"), "conversations", F.md5(F.concat(full(F.col("role")), F.lit("|"), full(F.col("text")))))))
        .unionByName(e.select(*row(F.col("vec_id"), "embeddings", F.concat(size, F.lit("|"), full(F.col("label"))))))
    )


@add("seeded", "K10", """
SELECT 'empty' AS target, n_nationkey AS k FROM nation UNION ALL SELECT 'filled', s_nationkey FROM supplier WHERE s_acctbal > 0""")
def seeded(spark, sf):
    """Seeds go onto an empty target only."""
    def seed():
        return t.table(spark, sf, "nation").select(F.col("n_nationkey").alias("k"))

    filled = t.table(spark, sf, "supplier").filter("s_acctbal > 0").select(F.col("s_nationkey").alias("k"))
    out = None
    for name, target in (("empty", filled.limit(0)), ("filled", filled)):
        rows = writes.seed_if_empty(target, seed)
        rows = (target if rows is None else target.unionByName(rows)).withColumn("target", F.lit(name))
        out = rows if out is None else out.unionByName(rows)
    return out.select("target", "k")
