"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skyledger.llm import (
    fingerprints,
    hard_negatives,
    html_text,
    line_dedup,
    manifest,
    near_dedup,
    neighbours,
    packing,
    quality,
    secrets,
    sentence_pieces,
    suffix_tree,
    warc,
)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs)


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edited(_read(spark, sf_dir, "documents"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_texts(_read(spark, sf_dir, "pages"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.piece_digests(packing.pack(_read(spark, sf_dir, "documents")))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return secrets.span_digests(secrets.find_secrets(docs, ["doc_id"]))


def op7_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.round_trip(_read(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_read(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_of_every(_read(spark, sf_dir, "embeddings"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return near_dedup.near_duplicates(docs, ["doc_id"]).select(
        "doc_id", "n_shingles", "component_id", "kept"
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(_read(spark, sf_dir, "embeddings"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.verify_tampered(_read(spark, sf_dir, "documents"))


def op13_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_line_dedup": op2_line_dedup,
    "op3_fingerprints": op3_fingerprints,
    "op4_html_text": op4_html_text,
    "op5_packing": op5_packing,
    "op6_secrets": op6_secrets,
    "op7_sentence_pieces": op7_sentence_pieces,
    "op8_warc": op8_warc,
    "op9_neighbours": op9_neighbours,
    "op10_near_dedup": op10_near_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_manifest": op12_manifest,
    "op13_suffix_tree": op13_suffix_tree,
}

OP2_SQL = """
WITH d AS (
  SELECT doc_id, source, text, string_split(text, chr(10)) AS lines,
         list_transform(string_split(text, chr(10)),
                        lambda x: trim(x, ' ' || chr(9) || chr(13))) AS bare
  FROM documents
), l AS (
  SELECT source, unnest(list_distinct(list_filter(bare, lambda x: x <> ''))) AS line FROM d
), t AS (
  SELECT source, count(*) AS total FROM documents GROUP BY source
), b AS (
  SELECT l.source, l.line
  FROM l JOIN t ON l.source IS NOT DISTINCT FROM t.source
  GROUP BY l.source, l.line, t.total
  HAVING count(*) >= 5 AND count(*) > t.total * CAST(0.1 AS DOUBLE)
), h AS (
  SELECT source, list(line) AS dropped FROM b GROUP BY source
), k AS (
  SELECT d.doc_id, d.source, d.text, d.lines, d.bare,
         CASE WHEN h.dropped IS NULL THEN d.lines
              ELSE list_filter(d.lines, lambda x: NOT list_contains(
                     h.dropped, trim(x, ' ' || chr(9) || chr(13)))) END AS kept
  FROM d LEFT JOIN h ON d.source IS NOT DISTINCT FROM h.source
)
SELECT doc_id, source,
       CASE WHEN text IS NOT NULL THEN array_to_string(kept, chr(10)) END AS text,
       CAST(coalesce(len(list_filter(bare, lambda x: x <> '')), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(lines) - len(kept), 0) AS BIGINT) AS n_dropped
FROM k
"""

OP8_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit'
            ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to
FROM g
"""

def _secrets_sql() -> str:
    """Spans by cutting at marks as well, but one row per part and a window sum."""
    cuts = []
    for i, (kind, pattern, group, least) in enumerate(secrets.PATTERNS):
        quoted = pattern.replace("'", "''")
        back = group.replace("$", "\\")
        bare = kind == "secret" and group == "$0"
        cuts.append(
            f"""SELECT r, {i} AS p, {secrets.KINDS.index(kind)} AS k, {least} AS least,
  {bare} AS bare, string_split(regexp_replace(replace(text, chr(1), chr(2)), '{quoted}',
    chr(1) || '\\0' || chr(1) || '{back}' || chr(1), 'g'), chr(1)) AS parts FROM d"""
        )
    names = " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(secrets.KINDS))
    roles = " ".join(f"WHEN {i} THEN '{secrets.PART[k]}'" for i, k in enumerate(secrets.KINDS))
    pairs = ", ".join(f"('{a}', '{b}')" for a, bs in secrets.COMPLETES.items() for b in bs)
    counts = ", ".join(
        f"count(*) FILTER (WHERE k = {i}) AS n_{kind}" for i, kind in enumerate(secrets.BASE)
    )
    listed = "string_agg(name || ':' || a || ':' || b, ',' ORDER BY a, k, b)"
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), m AS ({" UNION ALL ".join(cuts)}
), u AS (
  SELECT r, p, k, least, bare, unnest(parts) AS part, generate_subscripts(parts, 1) AS i
  FROM m WHERE len(parts) > 1
), q AS (
  SELECT *, lead(part) OVER w AS value,
         sum(CASE WHEN i % 3 = 0 THEN 0 ELSE length(part) END) OVER w AS b
  FROM u WINDOW w AS (PARTITION BY r, p ORDER BY i)
), s AS (
  SELECT DISTINCT r, k, CASE k {names} END AS name, CASE k {roles} END AS role,
         CAST(b - length(part) AS BIGINT) AS a, CAST(b AS BIGINT) AS b
  FROM q
  WHERE i % 3 = 2 AND length(value) >= least
    AND (NOT bare OR (length(part) = least AND regexp_matches(part, '[0-9]')
         AND regexp_matches(part, '[a-z]') AND regexp_matches(part, '[A-Z]')))
), c AS (SELECT * FROM (VALUES {pairs}) AS t(of_role, needs)
), kept AS (
  SELECT * FROM s WHERE k < {len(secrets.BASE)}
     OR EXISTS (SELECT 1 FROM s o JOIN c ON c.needs = o.role
                WHERE o.r = s.r AND c.of_role = s.role
                  AND o.a <= s.b + {secrets.SCOPE} AND o.b >= s.a - {secrets.SCOPE})
), g AS (
  SELECT r, {counts},
         {listed} FILTER (WHERE k < {len(secrets.BASE)}) AS base, {listed} AS spans
  FROM kept GROUP BY r
)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in secrets.BASE)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g ON g.r = d.r
"""


OP11_SQL = """
WITH r AS (
  SELECT DISTINCT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS INTEGER) AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), a AS (SELECT * FROM r WHERE vec_id % 50 = 0
), s AS (
  SELECT a.vec_id AS anchor_id, a.label AS l, a.v AS u, r.vec_id, r.label, r.v,
         CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM a JOIN r ON len(a.v) = len(r.v) AND (a.vec_id, a.label, a.v) <> (r.vec_id, r.label, r.v)
), p AS (
  SELECT anchor_id, l, u, vec_id AS positive_id, score AS positive_score FROM s WHERE l = label
  QUALIFY row_number() OVER (PARTITION BY anchor_id, l, u ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id,
       s.score AS negative_score,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.l, p.u, p.positive_id, p.positive_score
         ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.l = p.l AND s.u = p.u AND s.label <> p.l
  AND 100 * s.score BETWEEN 50 * p.positive_score AND 95 * p.positive_score
QUALIFY rank <= 3
"""


def _manifest_sql(levels: int = 9, top_levels: int = 4) -> str:
    """Level by level from the leaves: as many levels as stated, the rest of them idle."""

    def framed(value: str) -> str:
        text = f"CAST({value} AS VARCHAR)"
        return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"

    def tree(name: str, key: str, count: int) -> str:
        """Nodes ``name``_k and their siblings ``name``_s_k of trees by a key (or one tree)."""
        out = []
        same = f"PARTITION BY {key}" if key else ""
        run = f"PARTITION BY {key}, i // 8" if key else "PARTITION BY i // 8"
        keys = f"{key}, " if key else ""
        for k in range(count):
            out.append(
                f"""{name}_s_{k} AS (SELECT {keys}i, h, count(*) OVER ({same}) AS c,
    coalesce(string_agg(h, '') OVER ({run} ORDER BY i
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(h, '') OVER ({run} ORDER BY i
      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after FROM {name}_{k})"""
            )
            out.append(
                f"""{name}_{k + 1} AS (SELECT {keys}i // 8 AS i, CASE WHEN c > 1
    THEN sha256(string_agg(h, '' ORDER BY i)) ELSE max(h) END AS h
  FROM {name}_s_{k} GROUP BY {keys}i // 8, c)"""
            )
        return ",\n".join(out)

    def climb(name: str, key: str, place: str, frm: str, to: str, count: int) -> str:
        """Rows with the siblings at every level and the node folded with them."""
        out = []
        for k in range(count):
            same = f"p.{key} IS NOT DISTINCT FROM s.{key} AND " if key else ""
            out.append(
                f"""{to}_{k + 1} AS (SELECT p.* EXCLUDE (proof, f),
    CASE WHEN s.c > 1 THEN p.proof || s.before || s.after ELSE p.proof END AS proof,
    CASE WHEN s.c > 1 THEN sha256(s.before || p.f || s.after) ELSE p.f END AS f
  FROM {to + "_" + str(k) if k else frm} p
  JOIN {name}_s_{k} s ON {same}p.{place} // {8**k} = s.i)"""
            )
        return ",\n".join(out)

    crc = """xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT),
      list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), CAST(range(8) AS BIGINT[])),
      lambda a, i: xor(a >> 1, 3988292384 * (a & 1)))))"""
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    start = " || ".join(framed(c) for c in manifest.FIELDS[:-1])
    return f"""
WITH d AS (
  SELECT doc_id, lang, sha256({start} || {framed("text")}) AS leaf,
         CASE WHEN {crc} % {manifest.TAMPERED_EVERY} = 0
              THEN sha256({start} || {framed(lowered)}) END AS copy
  FROM documents
), l AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
         '' AS proof, coalesce(copy, leaf) AS f
  FROM d
), g_0 AS (SELECT lang, i, leaf AS h FROM l),
{tree("g", "lang", levels)},
r AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place
      FROM g_{levels}),
t_0 AS (SELECT place AS i, subroot AS h FROM r),
{tree("t", "", top_levels)},
{climb("g", "lang", "i", "l", "p", levels)},
q AS (SELECT p.*, r.subroot, r.place FROM p_{levels} p JOIN r ON p.lang IS NOT DISTINCT FROM r.lang),
{climb("t", "", "place", "q", "u", top_levels)}
SELECT doc_id, leaf, subroot, z.h AS root, sha256(proof) AS proof_sha256, f AS folded_root,
       f = z.h AS verified
FROM u_{top_levels}, t_{top_levels} z
"""


ORACLE: dict[str, str] = {
    "op2_line_dedup": OP2_SQL,
    "op6_secrets": _secrets_sql(),
    "op8_warc": OP8_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op12_manifest": _manifest_sql(),
}
