"""DuckDB SQL for the queries that SQL can express."""

DECONTAMINATION = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
gram AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS words
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM doc, (SELECT DISTINCT size FROM win))),
hit AS (SELECT doc_id, item_id, size, i FROM gram JOIN win USING (size, words)),
covered AS (
  SELECT doc_id, count(DISTINCT word_no) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS word_no FROM hit) GROUP BY doc_id),
owners AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN owners USING (doc_id)
"""

WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS payload_digest,
    CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
f AS (
  SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY html) END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NULL OR first IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM f
"""

EMBEDDINGS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (
  SELECT vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS size FROM v
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_sum(list_transform(e, lambda x: x * x)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.98),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
low AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT v.vec_id, (SELECT count(*) FROM link WHERE link.a = v.vec_id) AS n_links,
  low.component_id, v.vec_id = low.component_id AS kept
FROM v JOIN low ON low.a = v.vec_id
"""


def crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, by the rule of its reflected polynomial."""
    bits = "x"
    for _ in range(8):
        bits = f"list_transform([{bits}], lambda v: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)[1]"
    step = bits.replace("[x]", "[xor(a, b)]", 1)
    return (f"xor(4294967295, list_reduce(list_transform(string_split({text}, ''), lambda s: CAST(ascii(s) AS BIGINT)),"
            f" lambda a, b: {step}, CAST(4294967295 AS BIGINT)))")


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _field(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END"


def _levels(low: str, tag: str, n: int) -> str:
    """Relations ``{tag}1`` to ``{tag}n`` over ``{low}(grp, i, h)``: the levels above, and siblings beside each node."""
    out, below = [], low
    for k in range(n):
        run = "PARTITION BY grp, i // 8 ORDER BY i ROWS BETWEEN"
        out.append(f"""{tag}s{k} AS (SELECT *, count(*) OVER (PARTITION BY grp) AS n,
          coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
          coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {below})""")
        below = f"{tag}{k + 1}"
        out.append(f"""{below} AS (SELECT grp, i // 8 AS i,
          CASE WHEN n = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h
          FROM {tag}s{k} GROUP BY grp, i // 8, n)""")
    return ",\n".join(out)


def merkle(levels: int = 7, tops: int = 3) -> str:
    """Groups of up to ``8 ** levels`` rows, and ``8 ** tops`` groups at most; row ids are unique."""
    names = ("doc_id", "source", "lang", "n_chars", "text")
    leaf = " || ".join(map(_field, names))
    lowered = f"translate(text, '{UPPER}', '{LOWER}')"
    changed = " || ".join(_field(lowered if c == "text" else c) for c in names)
    joins, proof = [], []
    steps = [("s", k, "d.grp", "d.i") for k in range(levels)] + [("t", k, "''", "g.i") for k in range(tops)]
    folds, at = [], "start"
    for j, (tag, k, grp, i) in enumerate(steps):
        joins.append(f"JOIN {tag}s{k} AS x{j} ON x{j}.grp = {grp} AND x{j}.i = {i} // {8 ** k}")
        proof.append(f"x{j}.l || x{j}.r")
        folds.append(f"""f{j + 1} AS (SELECT * REPLACE (CASE WHEN p[{j + 1}].n = 1 THEN c
          ELSE sha256(p[{j + 1}].l || c || p[{j + 1}].r) END AS c) FROM {at})""")
        at = f"f{j + 1}"
    path = ", ".join(f"{{'n': x{j}.n, 'l': x{j}.l, 'r': x{j}.r}}" for j in range(len(steps)))
    return f"""WITH d0 AS (SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS grp,
  sha256({leaf}) AS h, CASE WHEN {crc32('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN sha256({changed})
    ELSE sha256({leaf}) END AS c FROM documents),
d AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST) - 1 AS i FROM d0),
{_levels("d", "s", levels)},
g AS (SELECT grp AS lang, h AS subroot, '' AS grp, h, row_number() OVER (ORDER BY CAST(grp AS BLOB)) - 1 AS i FROM s{levels}),
g0 AS (SELECT grp, i, h FROM g),
{_levels("g0", "t", tops)},
start AS (SELECT d.doc_id, d.h AS leaf, g.subroot, d.c, sha256({' || '.join(proof)}) AS proof_sha256, [{path}] AS p
  FROM d JOIN g ON g.lang = d.grp {' '.join(joins)}),
{','.join(folds)}
SELECT doc_id, leaf, subroot, (SELECT h FROM t{tops}) AS root, proof_sha256, c AS folded_root,
  c = (SELECT h FROM t{tops}) AS verified FROM {at}"""


MERKLE = merkle()

TRIE = f"""WITH t AS (
  SELECT conv_id AS c, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS s,
    CAST({crc32('CAST(conv_id AS VARCHAR)')} % 4 AS INT) AS h FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
r AS (SELECT t.c, list_concat(coalesce(b.s[1:t.h], []), t.s[t.h + 1:]) AS s FROM t LEFT JOIN t b ON b.c = t.c - t.c % 20),
v AS (SELECT c, s[1:d] AS k, d, len(s) = d AS last FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM r)),
n AS (SELECT k, d, min(c) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE last), '') AS ends,
    CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(k[d].text, '[^\\x20\\x09-\\x0D]+')) END AS own
  FROM v GROUP BY k, d),
f AS (SELECT n.*, (SELECT count(*) FROM n x WHERE x.d = n.d + 1 AND x.k[1:n.d] = n.k) AS n_children FROM n)
SELECT f.conv_id, f.d AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children,
  (SELECT count(*) FROM f x WHERE x.d >= f.d AND x.k[1:f.d] = f.k AND x.n_children = 0) AS n_leaves,
  (SELECT CAST(sum(x.own) AS BIGINT) FROM f x WHERE x.d >= f.d AND x.k[1:f.d] = f.k) AS saved_tokens,
  sha256(f.ends) AS ends_sha256
FROM f LEFT JOIN n p ON p.d = f.d - 1 AND p.k = f.k[1:f.d - 1]"""
