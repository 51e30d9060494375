"""DuckDB SQL: common table expressions for the manifest and what follows from it."""

from __future__ import annotations


def slug(x: str) -> str:
    return f"coalesce(nullif(trim(regexp_replace(regexp_replace(regexp_replace(lower(trim({x})), '[\\s\\-/\\\\.]+', '_', 'g'), '[^a-z0-9_]+', '_', 'g'), '_+', '_', 'g'), '_'), ''), 'unknown')"


BASE = """base AS (SELECT d.doc_id AS ordinal, d.source AS dataset_name, '1.0' AS dataset_version,
 upper(d.lang) || '___' || CASE l.quality WHEN 1 THEN 'Healthy' WHEN 0 THEN 'Low Quality' ELSE 'Unrated' END AS source_class,
 upper(d.lang) || '/' || d.doc_id || '.txt' AS source_relpath,
 substr(sha1(d.source || chr(31) || d.doc_id), 1, 16) AS image_id, strlen(d.text) AS file_size_bytes, d.n_chars AS width,
 CAST(len(string_split(d.text, chr(10))) AS BIGINT) AS height, CAST(len(string_split(d.text, ' ')) AS BIGINT) AS words, sha256(d.text) AS content_hash,
 sha1(lower(regexp_replace(d.text, '[ \\t\\r\\n]+', ' ', 'g'))) AS pixel_hash, d.text
 FROM documents d LEFT JOIN labels l USING (doc_id))"""

_CROP = slug("split_part(source_class, '___', 1)")
_CONDITION = slug("substr(source_class, strpos(source_class, '___') + 3)")

MANIFEST = f"""{BASE}, named AS (SELECT *, {_CROP} AS crop, CASE WHEN {_CONDITION} IN ('healthy', 'normal', 'fresh') THEN 'healthy' ELSE {_CONDITION} END AS condition FROM base),
 m AS (SELECT *, crop || '___' || condition AS label, width::DOUBLE * height / 1e6::DOUBLE AS megapixels, width::DOUBLE / height AS aspect_ratio,
 width::DOUBLE * 40 / words AS quality_blur_score, words * 255::DOUBLE / width AS quality_brightness, width::DOUBLE * 2 / (height * 10::DOUBLE) AS quality_contrast FROM named)"""

SCORED = f"""{MANIFEST}, parts AS (SELECT *, least(1::DOUBLE, greatest(0::DOUBLE, quality_blur_score / 400::DOUBLE)) AS c1,
 CASE WHEN quality_brightness BETWEEN 25 AND 235 THEN 1::DOUBLE WHEN quality_brightness < 25 THEN greatest(0::DOUBLE, quality_brightness / 25::DOUBLE) ELSE greatest(0::DOUBLE, (255::DOUBLE - quality_brightness) / 20::DOUBLE) END AS c2,
 least(1::DOUBLE, greatest(0::DOUBLE, quality_contrast / 70::DOUBLE)) AS c3, least(1::DOUBLE, greatest(0::DOUBLE, megapixels / 0.25::DOUBLE)) AS c4 FROM m),
 points AS (SELECT * EXCLUDE (c1, c2, c3, c4), round((c1 * 0.4::DOUBLE + c2 * 0.2::DOUBLE + c3 * 0.25::DOUBLE + c4 * 0.15::DOUBLE) / (0.4::DOUBLE + 0.2::DOUBLE + 0.25::DOUBLE + 0.15::DOUBLE), 6) AS quality_score FROM parts),
 s AS (SELECT *, CASE WHEN quality_score >= 0.85 THEN 'A' WHEN quality_score >= 0.70 THEN 'B' WHEN quality_score >= 0.55 THEN 'C' WHEN quality_score >= 0.40 THEN 'D' ELSE 'F' END AS quality_grade FROM points)"""

_VOTES = ", ".join(f"CASE WHEN sum(((m{i} >> {b}) & 1) * 2 - 1) > 0 THEN {1 << b} ELSE 0 END AS v{i}_{b}" for i in range(2) for b in range(32))
_WORDS = [" + ".join(f"v{i}_{b}" for b in range(32)) for i in range(2)]

HASHED = f"""{SCORED}, w AS (SELECT ordinal, unnest(list_distinct(list_filter(regexp_split_to_array(lower(text), '[ \\t\\r\\n]+'), lambda x: x <> ''))) AS w FROM s),
 wm AS (SELECT ordinal, ('0x' || substr(md5(w), 1, 8))::BIGINT AS m0, ('0x' || substr(md5(w), 9, 8))::BIGINT AS m1 FROM w),
 votes AS (SELECT ordinal, {_VOTES} FROM wm GROUP BY ordinal), vw AS (SELECT ordinal, ({_WORDS[0]})::BIGINT AS h0, ({_WORDS[1]})::BIGINT AS h1 FROM votes),
 h AS MATERIALIZED (SELECT s.*, coalesce(h0, 0) AS h0, coalesce(h1, 0) AS h1, printf('%08x', coalesce(h0, 0)) || printf('%08x', coalesce(h1, 0)) AS perceptual_hash FROM s LEFT JOIN vw USING (ordinal))"""

DISTANCE = "(bit_count(xor(x.h0, y.h0)) + bit_count(xor(x.h1, y.h1)))"

CLUSTERED = f"""{HASHED}, e AS (SELECT x.ordinal AS a, y.ordinal AS b FROM h x JOIN h y ON x.ordinal <> y.ordinal WHERE x.content_hash = y.content_hash OR x.pixel_hash = y.pixel_hash OR {DISTANCE} <= 5),
 r(a, b) AS (SELECT a, a FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a), roots AS (SELECT a AS ordinal, min(b) AS root FROM r GROUP BY a),
 mem AS (SELECT roots.root, h.*, row_number() OVER (PARTITION BY roots.root ORDER BY h.quality_score DESC, h.ordinal) AS rk, count(*) OVER (PARTITION BY roots.root) AS cluster_size FROM roots JOIN h USING (ordinal)),
 rep AS (SELECT root, ordinal AS representative, image_id AS duplicate_group, content_hash AS rc, pixel_hash AS rp, h0 AS r0, h1 AS r1 FROM mem WHERE rk = 1),
 grouped AS (SELECT mem.*, representative, duplicate_group, CASE WHEN ordinal = representative THEN 'representative' WHEN content_hash = rc OR pixel_hash = rp THEN 'exact_duplicate' ELSE 'near_duplicate' END AS kind,
  CASE WHEN ordinal = representative THEN NULL WHEN content_hash = rc OR pixel_hash = rp THEN 1::DOUBLE ELSE round(1 - (bit_count(xor(h0, r0)) + bit_count(xor(h1, r1))) / 64::DOUBLE, 6) END AS similarity FROM mem JOIN rep USING (root))"""

GATED = f"""{CLUSTERED}, st AS (SELECT h.*, g.duplicate_group, coalesce(g.kind, 'unique') AS quality_duplicate_status FROM h LEFT JOIN grouped g USING (ordinal)),
 failing AS (SELECT *, list_filter([CASE WHEN quality_blur_score < 80 THEN 'blurry' END, CASE WHEN quality_brightness < 25 THEN 'too_dark' END, CASE WHEN quality_brightness > 235 THEN 'too_bright' END,
  CASE WHEN quality_contrast < 15 THEN 'low_contrast' END, CASE WHEN width < 64 THEN 'low_resolution' END, CASE WHEN height < 64 THEN 'low_resolution' END,
  CASE WHEN aspect_ratio < 0.25 OR aspect_ratio > 4 THEN 'extreme_aspect_ratio' END], lambda x: x IS NOT NULL) AS all_failures FROM st),
 lenient AS (SELECT * EXCLUDE (all_failures), list_filter([CASE WHEN quality_blur_score < 80 THEN 'blurry' END, CASE WHEN quality_brightness < 25 THEN 'too_dark' END, CASE WHEN quality_brightness > 235 THEN 'too_bright' END,
  CASE WHEN quality_contrast < 15 THEN 'low_contrast' END, CASE WHEN width < 300 THEN 'low_resolution' END,
  CASE WHEN aspect_ratio < 0.25 OR aspect_ratio > 2000 THEN 'extreme_aspect_ratio' END], lambda x: x IS NOT NULL) AS failures FROM failing),
 coded AS (SELECT *, CASE WHEN quality_duplicate_status IN ('exact_duplicate', 'near_duplicate') THEN quality_duplicate_status WHEN len(failures) > 0 THEN failures[1] WHEN quality_score < 0.35 THEN 'low_quality_score' END AS rejection_code FROM lenient),
 g AS (SELECT *, CASE WHEN rejection_code IS NOT NULL THEN 'reject' WHEN quality_score < 0.55 THEN 'warn' ELSE 'accept' END AS action, CASE WHEN rejection_code IS NULL THEN 'accepted' ELSE 'rejected' END AS status FROM coded)"""

#: The gate with exact duplicates warned of and near ones kept.
KEPT = GATED.replace("CASE WHEN quality_duplicate_status IN ('exact_duplicate', 'near_duplicate') THEN quality_duplicate_status WHEN len", "CASE WHEN len").replace("WHEN quality_score < 0.55 THEN 'warn'", "WHEN quality_score < 0.55 OR quality_duplicate_status = 'exact_duplicate' THEN 'warn'")


def over(ctes: str, select: str) -> str:
    return f"WITH RECURSIVE {ctes} {select}"
