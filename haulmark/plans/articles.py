"""Registered queries: article display, duplicates, succession, consolidation and claims."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import articles as art
from ..operators import claims, similarity
from ..sources import news
from . import series as series_plans
from . import tables as t
from .registry import REGISTRY

add = REGISTRY.add

NOW = "2024-03-01T00:00:00Z"


# --- display --------------------------------------------------------------------------------------


def canonical(spark, sf):
    """Judged documents; articles of one source and language point to the first relevant one."""
    a = t.document_articles(spark, sf)
    first = a.filter("relevant").groupBy("source", "lang").agg(F.min("raw_ref").alias("_first"))
    return a.join(first, ["source", "lang"], "left").select(
        "raw_ref",
        "relevant",
        F.when(F.col("_first") < F.col("raw_ref"), F.col("_first")).alias("duplicate_of"),
        (F.col("lang") == "fr").alias("manual_override"),
        "hidden",
        F.col("day").cast("string").alias("published_date"),
        F.col("source").alias("title"),
    )


CANON_SQL = f"""
{t.ART_SQL}, can AS (
  SELECT raw_ref, relevant, CASE WHEN f.f < raw_ref THEN f.f END AS duplicate_of, lang = 'fr' AS manual_override,
         hidden, day::VARCHAR AS published_date, source AS title FROM art LEFT JOIN (SELECT source, lang, min(raw_ref) AS f FROM art WHERE relevant GROUP BY ALL) f USING (source, lang))"""


@add("visible_articles", "P9 J3 S23", f"""
WITH {CANON_SQL}
SELECT raw_ref, lang FROM can JOIN documents ON doc_id = raw_ref
WHERE coalesce(relevant, false) AND (duplicate_of IS NULL OR manual_override) AND NOT hidden""")
def visible_articles(spark, sf):
    raw = t.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "lang")
    return art.visible(canonical(spark, sf), raw).select("raw_ref", "lang")


@add("publishable_articles", "P8 F12", f"""
WITH {t.ART_SQL} SELECT raw_ref, day::VARCHAR AS day FROM art WHERE relevant AND day::VARCHAR >= '2024-01-15'""")
def publishable_articles(spark, sf):
    a = t.document_articles(spark, sf).select(
        "raw_ref", F.col("day").cast("string").alias("day"), F.when(F.col("relevant"), "yes").alias("flag")
    )
    return art.publishable(a, flag="flag", day="day", cutoff=F.lit("2024-01-15")).select("raw_ref", "day")


@add("not_visible", "J17", f"""
WITH {CANON_SQL}
SELECT raw_ref FROM can WHERE manual_override AND NOT (coalesce(relevant, false) AND (duplicate_of IS NULL OR manual_override) AND NOT hidden)""")
def not_visible(spark, sf):
    c = canonical(spark, sf)
    return art.not_visible(c.filter("manual_override").select("raw_ref"), c)


@add("cluster_mates", "J13", f"""
WITH {CANON_SQL}
SELECT m.raw_ref, m.duplicate_of, c.hidden AS canonical_hidden FROM can m JOIN can c ON c.raw_ref = m.duplicate_of""")
def cluster_mates(spark, sf):
    c = canonical(spark, sf)
    lead = c.select(F.col("raw_ref").alias("duplicate_of"), F.col("hidden").alias("canonical_hidden"))
    return c.join(lead, "duplicate_of").select("raw_ref", "duplicate_of", "canonical_hidden")


# --- similarity -----------------------------------------------------------------------------------


@add("window_sizes", "J11 D2", f"""
WITH {t.ART_SQL}, n AS (SELECT day, count(*) AS n_new FROM art WHERE NOT judged GROUP BY 1),
s AS (SELECT day, count(*) AS n FROM art WHERE judged GROUP BY 1)
SELECT n.day, n_new, coalesce((SELECT sum(s.n) FROM s WHERE s.day BETWEEN n.day - 3 AND n.day + 3), 0)::BIGINT AS n_window FROM n""")
def window_sizes(spark, sf):
    a = t.document_articles(spark, sf)
    return similarity.window_sizes(a.filter(~F.col("judged")), a.filter("judged"))


def title_nodes(df):
    return df.select(
        F.col("raw_ref").cast("bigint").alias("node"),
        "title",
        F.datediff("day", F.lit("1970-01-01").cast("date")).alias("day_no"),
        F.lit(False).alias("settled"),
    ).filter("title <> ''")


PAGE_SQL = r"""
pg AS MATERIALIZED (
  SELECT page_id AS raw_ref, (DATE '2024-01-01' + (page_id % 30)::INTEGER)::DATE AS day, url,
    regexp_replace(replace(replace(replace(replace(replace(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1),
      '<[^>]+>', '', 'g'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '^\s+|\s+$', '', 'g') AS title
  FROM pages)"""

#: ``ratio(a, b, r)`` of the title pairs of ``need(a, b)``: the longest block first, then left and right of it, and so on.
#: Titles of 200 characters and more would also need the library's rule for popular characters.
RATIO_SQL = """
pair AS MATERIALIZED (SELECT row_number() OVER () AS p, a, b FROM (SELECT DISTINCT a, b FROM need)),
ca AS (SELECT p, i, substring(a, i, 1) AS ch FROM (SELECT p, a, unnest(range(1, length(a) + 1)) AS i FROM pair)),
cb AS (SELECT p, j, substring(b, j, 1) AS ch FROM (SELECT p, b, unnest(range(1, length(b) + 1)) AS j FROM pair)),
eq AS MATERIALIZED (SELECT p, i, j FROM ca JOIN cb USING (p, ch)),
seg AS (
  SELECT p, 1::BIGINT AS alo, length(a) + 1 AS ahi, 1::BIGINT AS blo, length(b) + 1 AS bhi, 0::BIGINT AS m FROM pair
  UNION ALL
  SELECT p, unnest([alo, i + m]), unnest([i, ahi]), unnest([blo, j + m]), unnest([j, bhi]), unnest([m, 0]) FROM (
    SELECT p, alo, ahi, blo, bhi, max(k) AS m, arg_max(i, (k, -i, -j)) AS i, arg_max(j, (k, -i, -j)) AS j FROM (
      SELECT p, alo, ahi, blo, bhi, min(i) AS i, min(j) AS j, count(*) AS k FROM (
        SELECT seg.p, alo, ahi, blo, bhi, i, j, i - row_number() OVER (PARTITION BY seg.p, alo, ahi, blo, bhi, i - j ORDER BY i) AS run
        FROM seg JOIN eq ON eq.p = seg.p AND i >= alo AND i < ahi AND j >= blo AND j < bhi)
      GROUP BY p, alo, ahi, blo, bhi, i - j, run)
    GROUP BY p, alo, ahi, blo, bhi)),
ratio AS MATERIALIZED (SELECT a, b, 2.0 * sum(m) / (length(a) + length(b)) AS r FROM seg JOIN pair USING (p) GROUP BY p, a, b)"""


@add("similar_titles", "J11 D2 F29", f"""
WITH RECURSIVE {PAGE_SQL},
w AS MATERIALIZED (SELECT n.raw_ref AS node, c.raw_ref AS cand, n.title AS a, c.title AS b FROM pg n JOIN pg c ON abs(n.day - c.day) <= 3 AND (c.day, c.raw_ref) < (n.day, n.raw_ref)
  WHERE n.title <> '' AND c.title <> '' AND 2 * least(length(n.title), length(c.title)) >= 0.72 * (length(n.title) + length(c.title))),
need AS (SELECT a, b FROM w), {RATIO_SQL}
SELECT node, cand, round(r, 6) AS ratio FROM w JOIN ratio USING (a, b) WHERE r >= 0.72""")
def similar_titles(spark, sf):
    """Page titles within three days whose ratio reaches the threshold."""
    nodes = title_nodes(t.page_articles(spark, sf))
    pairs = similarity.similar_rows(nodes, nodes)
    return pairs.select("node", "cand", F.round("ratio", 6).alias("ratio"))


@add("review_candidates", "D2 T9", f"""
WITH RECURSIVE {PAGE_SQL},
w AS MATERIALIZED (SELECT n.raw_ref AS node, c.raw_ref AS cand, c.day, n.title AS a, c.title AS b FROM pg n JOIN pg c ON abs(n.day - c.day) <= 3
  WHERE n.url LIKE 'https://%' AND c.url NOT LIKE 'https://%' AND n.title <> '' AND c.title <> ''),
need AS (SELECT a, b FROM w), {RATIO_SQL},
x AS (SELECT node, cand, day, r >= 0.3 AS loose, max(r) OVER (PARTITION BY node) >= 0.3 AS found FROM w JOIN ratio USING (a, b)),
o AS (SELECT node, cand, loose, row_number() OVER (PARTITION BY node ORDER BY day, cand)::INTEGER AS position FROM x WHERE loose OR NOT found)
SELECT * FROM o WHERE position <= 20""")
def review_candidates(spark, sf):
    """Candidates shown to an outside judge: pages of one site family against all the others."""
    a = t.page_articles(spark, sf)
    fresh = F.col("url").startswith("https://")
    return similarity.review_candidates(title_nodes(a.filter(fresh)), title_nodes(a.filter(~fresh)), limit=20)


@add("assigned_duplicates", "D3 F29 J11", f"""
WITH RECURSIVE {PAGE_SQL},
nd AS MATERIALIZED (SELECT trim(title) AS title, day, url NOT LIKE 'https://%' AS settled, min(raw_ref) AS node FROM pg WHERE trim(title) <> '' GROUP BY ALL),
w AS MATERIALIZED (SELECT n.node, c.node AS cand, c.day, c.settled, n.title AS a, c.title AS b FROM nd n JOIN nd c ON abs(n.day - c.day) <= 3 AND (c.settled OR (c.day, c.node) < (n.day, n.node))
  WHERE NOT n.settled AND 2 * least(length(n.title), length(c.title)) >= 0.72 * (length(n.title) + length(c.title))),
need AS (SELECT a, b FROM w), {RATIO_SQL},
hit AS MATERIALIZED (SELECT node, cand, day, settled FROM w JOIN ratio USING (a, b) WHERE r >= 0.72),
old AS MATERIALIZED (SELECT node, arg_min(cand, (day, cand)) AS target FROM hit WHERE settled GROUP BY node),
nb AS MATERIALIZED (SELECT * FROM hit WHERE NOT settled AND node NOT IN (SELECT node FROM old) AND cand NOT IN (SELECT node FROM old)),
todo AS MATERIALIZED (SELECT node, row_number() OVER (ORDER BY day, node) AS rn, coalesce((SELECT list(cand) FROM nb WHERE nb.node = nd.node), []) AS near
  FROM nd WHERE NOT settled AND node NOT IN (SELECT node FROM old)),
walk AS (
  SELECT 0::BIGINT AS rn, []::BIGINT[] AS canon
  UNION ALL
  SELECT todo.rn, CASE WHEN list_has_any(near, canon) THEN canon ELSE list_append(canon, node) END FROM walk JOIN todo ON todo.rn = walk.rn + 1),
canon AS MATERIALIZED (SELECT unnest(canon) AS node FROM (SELECT canon FROM walk ORDER BY rn DESC LIMIT 1)),
target AS (SELECT node, target FROM old UNION ALL SELECT node, arg_min(cand, (day, cand)) FROM nb WHERE cand IN (SELECT node FROM canon) GROUP BY node),
mine AS (SELECT title, day, node FROM nd WHERE NOT settled)
SELECT raw_ref, coalesce(target, CASE WHEN raw_ref <> node THEN node END) AS duplicate_of, node IS NOT NULL OR url NOT LIKE 'https://%' AS judged, node IS NOT NULL AS judged_now
FROM pg LEFT JOIN mine ON mine.title = trim(pg.title) AND mine.day = pg.day AND url LIKE 'https://%' LEFT JOIN target USING (node)""")
def assigned_duplicates(spark, sf):
    """Pages judged in order of day and id, those over plain http settled before."""
    a = t.page_articles(spark, sf).select(
        "raw_ref", "day", "title", (~F.col("url").startswith("https://")).alias("judged"), F.lit(None).cast("bigint").alias("duplicate_of")
    )
    return art.assign_canonical(a)


@add("assigned_copies", "D3", f"""
WITH RECURSIVE {t.ART_SQL.replace("art AS", "art0 AS", 1)}, art AS (SELECT raw_ref, day, trim(title) AS title FROM art0 WHERE trim(title) <> ''),
nodes AS (SELECT title, day, min(raw_ref) AS node FROM art GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY day, node) AS rn FROM nodes),
walk AS (
  SELECT title, day, node, rn, node AS lead, day AS lead_day FROM ranked WHERE rn = 1
  UNION ALL
  SELECT r.title, r.day, r.node, r.rn, CASE WHEN r.day - w.lead_day <= 3 THEN w.lead ELSE r.node END,
         CASE WHEN r.day - w.lead_day <= 3 THEN w.lead_day ELSE r.day END
  FROM walk w JOIN ranked r ON r.title = w.title AND r.rn = w.rn + 1)
SELECT raw_ref, nullif(lead, raw_ref) AS duplicate_of FROM art JOIN walk USING (title, day)""")
def assigned_copies(spark, sf):
    """Whole documents as titles with an outside judge that accepts equal texts only."""
    a = t.document_articles(spark, sf).select(
        "raw_ref", "day", "title", F.lit(False).alias("judged"), F.lit(None).cast("bigint").alias("duplicate_of")
    ).filter(F.trim("title") != "")
    day_no = F.datediff("day", F.lit("1970-01-01").cast("date")).alias("day_no")
    node = a.groupBy(F.trim("title").alias("title"), day_no).agg(F.min("raw_ref").alias("node"))
    pairs = similarity.equal_titles(node)
    return art.assign_canonical(a, pairs=pairs).select("raw_ref", "duplicate_of")


# --- succession and consolidation -------------------------------------------------------------------

SUCC_SQL = f"""
{CANON_SQL}, heirs AS (
  SELECT m.duplicate_of AS old_ref, arg_min(m.raw_ref, (m.published_date, m.raw_ref)) AS new_ref FROM can m
  WHERE m.relevant AND m.duplicate_of IS NOT NULL AND NOT m.manual_override AND NOT m.hidden GROUP BY 1
), ev AS (SELECT h.old_ref, h.new_ref FROM heirs h JOIN can c ON c.raw_ref = h.old_ref AND c.relevant AND c.hidden)"""


@add("succession_events", "D4 D9 W5 J13", f"""
WITH {SUCC_SQL}
SELECT old_ref, o.title AS old_title, new_ref, n.title AS new_title FROM ev JOIN can o ON o.raw_ref = old_ref JOIN can n ON n.raw_ref = new_ref""")
def succession_events(spark, sf):
    return art.succession(canonical(spark, sf)).events


@add("succession_rows", "D4", f"""
WITH {SUCC_SQL}
SELECT c.raw_ref, CASE WHEN f.new_ref = c.raw_ref AND c.relevant THEN NULL WHEN y.new_ref IS NOT NULL THEN y.new_ref
  WHEN f.new_ref IS NOT NULL AND NOT c.manual_override AND coalesce(c.relevant, false) THEN f.new_ref ELSE c.duplicate_of END AS duplicate_of
FROM can c LEFT JOIN ev f ON f.old_ref = c.duplicate_of LEFT JOIN ev y ON y.old_ref = c.raw_ref""")
def succession_rows(spark, sf):
    return art.succession(canonical(spark, sf)).rows.select("raw_ref", "duplicate_of")


def legacy(spark, sf):
    """Documents as physical copies of articles: one id per source and language, swapped columns."""
    d = t.table(spark, sf, "documents").join(t.table(spark, sf, "labels"), "doc_id", "left")
    aid = lambda lang: text.content_hash(F.col("source"), lang)
    done = F.col("quality").isNotNull()
    return d.select(
        F.col("doc_id").alias("row_no"),
        aid(F.col("lang")).alias("article_id"),
        F.concat(F.lit("https://www."), F.col("source"), F.lit(".example.com:8080/"), F.col("doc_id").cast("string")).alias("title"),
        F.concat(F.lit("headline "), F.col("doc_id").cast("string")).alias("url"),
        F.col("text").alias("content_hash"),
        F.lit("2024-01-01").alias("published_date"),
        "source",
        F.when(done, F.col("lang")).otherwise("").alias("category"),
        F.when(done, F.concat(F.lit("t"), F.col("doc_id").cast("string"))).otherwise("").alias("english_title"),
        F.when(done, F.concat(F.lit("s"), F.col("toxic").cast("string"))).otherwise("").alias("english_summary"),
        F.when(done, F.concat(F.lit("2024-01-"), F.lpad((F.col("n_chars") % 28 + 1).cast("string"), 2, "0"))).otherwise("").alias("ai_processed_at"),
        F.when((F.col("quality") == 1) & (F.col("lang") != "de"), "true").otherwise("FALSE").alias("include_on_site"),
        F.when(F.col("source") == "src7", "").otherwise("2023-12-31").alias("crawled_at"),
        F.when(F.col("toxic") == 1, F.when(F.col("lang") == "en", aid(F.lit("zz"))).otherwise(aid(F.lit("en"))))
        .when(F.col("quality") == 0, art.JUDGED_NONE)
        .otherwise("")
        .alias("duplicate_of_article_id"),
        F.when(F.col("lang") == "fr", "2024-02-02").otherwise("").alias("dedup_judged_at"),
        F.when(F.col("n_chars") > 15000, "TRUE").otherwise("").alias("manual_override"),
    )


LEG_SQL = f"""
leg AS (
  SELECT doc_id AS seq, substr(sha256(source || lang), 1, 16) AS id, source, 'https://www.' || source || '.example.com:8080/' || doc_id AS link,
    'headline ' || doc_id AS head, trim(text) AS descr, CASE WHEN quality IS NOT NULL THEN lang ELSE '' END AS category,
    CASE WHEN quality IS NOT NULL THEN 't' || doc_id ELSE '' END AS et, CASE WHEN quality IS NOT NULL THEN 's' || toxic ELSE '' END AS es,
    CASE WHEN quality IS NOT NULL THEN '2024-01-' || lpad((n_chars % 28 + 1)::VARCHAR, 2, '0') ELSE '' END AS pa,
    coalesce(quality = 1 AND lang <> 'de', false) AS shown, CASE WHEN source = 'src7' THEN '' ELSE '2023-12-31' END AS crawled,
    CASE WHEN toxic = 1 THEN substr(sha256(source || CASE WHEN lang = 'en' THEN 'zz' ELSE 'en' END), 1, 16) WHEN quality = 0 THEN 'none' ELSE '' END AS dup,
    CASE WHEN lang = 'fr' THEN '2024-02-02' ELSE '' END AS dj, n_chars > 15000 AS ov
  FROM documents LEFT JOIN labels USING (doc_id)
), g AS (
  SELECT id, bool_or(shown) AS any_shown, bool_or(ov) AS override, min(seq) FILTER (WHERE shown) AS shown_seq,
    arg_max(seq, (pa, -seq)) FILTER (WHERE pa <> '') AS late_seq, arg_min(pa, seq) FILTER (WHERE pa <> '') AS first_pa,
    min(seq) FILTER (WHERE dup <> '') AS track_seq, count(DISTINCT category || '|' || es) FILTER (WHERE pa <> '') AS n_text FROM leg GROUP BY id
), c AS (
  SELECT g.*, tr.dup, tr.dj, tr.crawled AS tcrawled, coalesce(tr.dup <> 'none', false) AS mate, r.id IS NOT NULL AS found,
    any_shown OR coalesce(tr.dup <> 'none', false) AS relevant, s.category, s.et, s.es, s.pa
  FROM g LEFT JOIN leg tr ON tr.seq = g.track_seq LEFT JOIN leg s ON s.seq = coalesce(g.shown_seq, g.late_seq)
  LEFT JOIN (SELECT DISTINCT id FROM leg) r ON r.id = tr.dup WHERE first_pa IS NOT NULL)"""


def consolidated(spark, sf):
    return art.consolidate(legacy(spark, sf), now=F.lit(NOW), check=False)


@add("consolidated_raw", "D5 W4 F9 F11", f"""
WITH {LEG_SQL}, f AS (SELECT id, min(seq) AS seq FROM leg GROUP BY 1)
SELECT leg.id AS content_hash, link AS url, head AS title_ko, descr AS description, '2024-01-01' AS published_date, source AS source_name,
       source || '.example.com:8080' AS source_domain, CASE WHEN crawled = '' THEN '{NOW}' ELSE crawled END AS collected_at
FROM f JOIN leg USING (seq)""")
def consolidated_raw(spark, sf):
    return consolidated(spark, sf).raw


@add("consolidated_articles", "D6 A19 J12", f"""
WITH {LEG_SQL}
SELECT id AS raw_ref, relevant, CASE WHEN relevant THEN pa ELSE first_pa END AS relevance_judged_at,
  CASE WHEN relevant THEN category END AS category, CASE WHEN relevant THEN et END AS english_title, CASE WHEN relevant THEN es END AS english_summary,
  CASE WHEN relevant THEN pa END AS classified_at, CASE WHEN mate AND found THEN dup END AS duplicate_of,
  CASE WHEN track_seq IS NOT NULL THEN coalesce(nullif(dj, ''), nullif(tcrawled, ''), '{NOW}') END AS dedup_judged_at,
  override AS manual_override, false AS hidden FROM c""")
def consolidated_articles(spark, sf):
    return consolidated(spark, sf).canonical


@add("consolidation_counts", "A24 J12", f"""
WITH {LEG_SQL}
SELECT count(*) AS canonical_rows, count(*) FILTER (WHERE n_text > 1) AS inconsistent_text, count(*) FILTER (WHERE mate AND NOT found) AS dangling_pointers,
       count(*) FILTER (WHERE track_seq IS NOT NULL AND dj = '') AS stamps_filled FROM c""")
def consolidation_counts(spark, sf):
    return consolidated(spark, sf).counts


@add("malformed_ids", "F11 D5", """
SELECT doc_id AS row_no FROM documents LEFT JOIN labels USING (doc_id) WHERE coalesce(quality, 0) = 0 AND lang <> 'en'""")
def malformed_ids(spark, sf):
    broken = (F.col("include_on_site") == "FALSE") & (F.col("url") != "") & (F.col("article_id") != "")
    rows = legacy(spark, sf).join(t.table(spark, sf, "documents").select(F.col("doc_id").alias("row_no"), "lang"), "row_no")
    q = t.table(spark, sf, "labels").select(F.col("doc_id").alias("row_no"), "quality")
    rows = rows.join(q, "row_no", "left").withColumn(
        "article_id",
        F.when(broken & (F.coalesce("quality", F.lit(0)) == 0) & (F.col("lang") != "en"), F.upper(F.concat(F.lit("x"), "article_id"))).otherwise(F.col("article_id")),
    )
    return art.malformed_ids(rows).select("row_no")


# --- claims ---------------------------------------------------------------------------------------


def quoted(spark, sf):
    """Conversation turns, each ending with figures about itself."""
    c = t.table(spark, sf, "conversations")
    tail = F.format_string(
        " In total %s KG, %.1f%% up, %d articles and %s tonnes.",
        F.format_number(F.col("conv_id") * 1000 + F.col("turn"), 0), F.col("turn") * 1.5, F.col("conv_id"), (F.col("conv_id") % 50).cast("string"),
    )
    return c.select("conv_id", "turn", F.concat("text", tail).alias("text"))


QUOTED_SQL = """
q AS (SELECT conv_id, turn, text || ' In total ' || format('{:,}', conv_id * 1000 + turn) || ' KG, ' || printf('%.1f', turn * 1.5) || '% up, '
  || conv_id || ' articles and ' || (conv_id % 50) || ' tonnes.' AS text FROM conversations),
cl AS (
  SELECT conv_id, turn, unnest(range(len(ns))) AS position, unnest(ns) AS n, unnest(us) AS u FROM (
    SELECT conv_id, turn, regexp_extract_all(text, '(?i)(\\d[\\d,]*\\.?\\d*)\\s*(%|kg|kilograms?|tonnes?|dmt|articles?|declarations?|records?)', 1) AS ns,
           regexp_extract_all(text, '(?i)(\\d[\\d,]*\\.?\\d*)\\s*(%|kg|kilograms?|tonnes?|dmt|articles?|declarations?|records?)', 2) AS us FROM q)
), claim AS (
  SELECT conv_id, turn, position, n || u AS cited, CASE WHEN lower(u) = '%' THEN '%' WHEN lower(u) LIKE 'k%' THEN 'kg' WHEN lower(u) LIKE 'tonne%' OR lower(u) = 'dmt' THEN 'tonnes'
         WHEN lower(u) LIKE 'article%' THEN 'articles' WHEN lower(u) LIKE 'decl%' THEN 'declarations' ELSE 'records' END AS unit,
         replace(n, ',', '')::DOUBLE AS value FROM cl)"""

FIGURES_SQL = f"""
{t.OBS_SQL}, {series_plans.KPI_SQL}, fig AS (
  SELECT 'kg' AS unit, replace(import_kg, ',', '')::DOUBLE AS value FROM kpi
  UNION SELECT 'tonnes', replace(export_tonnes, ',', '')::DOUBLE FROM kpi
  UNION SELECT 'articles', articles_90d::DOUBLE FROM kpi
  UNION SELECT 'declarations', declarations_90d::DOUBLE FROM kpi
  UNION SELECT '%', regexp_extract(export_delta, '(\\d+\\.?\\d*)\\s*%', 1)::DOUBLE FROM kpi
  UNION SELECT '%', regexp_extract(import_yoy, '(\\d+\\.?\\d*)\\s*%', 1)::DOUBLE FROM kpi)"""


def figures(spark, sf):
    kpis = REGISTRY.queries["headline_kpis"](spark, sf)
    return claims.reference_figures(
        kpis,
        [
            ("kg", F.col("import_kg")),
            ("tonnes", F.col("export_tonnes")),
            ("articles", F.col("articles_90d")),
            ("declarations", F.col("declarations_90d")),
            ("%", F.col("export_delta")),
            ("%", F.col("import_yoy")),
        ],
    )


@add("cited_figures", "F19", f"WITH {QUOTED_SQL} SELECT conv_id, turn, position::INTEGER AS position, cited, unit, value FROM claim")
def cited_figures(spark, sf):
    return claims.extract_claims(quoted(spark, sf), key=["conv_id", "turn"], text="text")


@add("reference_figures", "A29 F20", f"WITH {FIGURES_SQL} SELECT unit, value FROM fig")
def reference_figures(spark, sf):
    return figures(spark, sf)


OK_SQL = "EXISTS (SELECT 1 FROM fig f WHERE f.unit = c.unit AND (abs(c.value - f.value) <= 0.5 OR (f.value <> 0 AND abs(c.value - f.value) / abs(f.value) <= 0.02)))"


@add("unsupported_claims", "J18", f"""
WITH {FIGURES_SQL}, {QUOTED_SQL} SELECT conv_id, turn, position::INTEGER AS position, cited, unit, value FROM claim c WHERE NOT {OK_SQL}""")
def unsupported_claims(spark, sf):
    return claims.unsupported_claims(cited_figures(spark, sf), figures(spark, sf))


@add("checked_texts", "D7 J18", f"""
WITH {FIGURES_SQL}, {QUOTED_SQL}, w AS (
  SELECT conv_id, turn, string_agg(cited, ', ' ORDER BY position) AS l FROM claim c WHERE NOT {OK_SQL} GROUP BY ALL)
SELECT conv_id, turn, CASE WHEN l IS NULL THEN 'ok' ELSE 'review_needed' END AS status,
       CASE WHEN l IS NULL THEN '' ELSE 'not found among this build''s figures: ' || l END AS detail FROM q LEFT JOIN w USING (conv_id, turn)""")
def checked_texts(spark, sf):
    return claims.check_texts(quoted(spark, sf), figures(spark, sf), key=["conv_id", "turn"], text="text")


# --- news items -----------------------------------------------------------------------------------


@add("news_items", "S19 F7 F8 F9 F10 U6", """
WITH p AS (SELECT page_id, url, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS raw FROM pages),
u AS (SELECT page_id, CASE WHEN url LIKE 'https:%' THEN url ELSE '' END AS orig, url AS u,
  regexp_replace(replace(replace(replace(replace(replace(regexp_replace(raw, '<[^>]+>', '', 'g'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '^\\s+|\\s+$', '', 'g') AS title FROM p)
SELECT u AS url, title AS title_ko, '' AS description, (DATE '2024-01-01' + (page_id % 28)::INTEGER)::VARCHAR AS published_date,
  replace(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), 'www.', '') AS source_name,
  replace(regexp_extract(orig, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), 'www.', '') AS source_domain,
  substr(sha256(u || title), 1, 16) AS content_hash, 'kw' || (page_id % 3) AS keyword_matched FROM u""")
def news_items(spark, sf):
    p = t.table(spark, sf, "pages")
    stamp = F.concat(
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 28).cast("int")), "EEE, dd MMM yyyy"),
        F.lit(" 23:30:00 +0900"),
    )
    item = F.struct(
        F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1).alias("title"),
        F.when(F.col("url").startswith("https:"), F.col("url")).otherwise("").alias("originallink"),
        F.col("url").alias("link"),
        F.lit("").alias("description"),
        stamp.alias("pubDate"),
    )
    landed = p.groupBy(F.concat(F.lit("kw"), (F.col("page_id") % 3).cast("string")).alias("keyword"), "page_id").agg(
        F.to_json(F.struct(F.array(F.first(item)).alias("items"))).alias("body")
    )
    return news.news_articles(landed, body="body", keyword="keyword")
