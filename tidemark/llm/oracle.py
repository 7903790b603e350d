"""DuckDB SQL of the queries of this subpackage that SQL can express on whole tables."""

from tidemark.llm import licenses

WORD = r"[^\x20\x09-\x0D]+"

OP2 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents
), m AS (
  SELECT doc_id, ws, len(ws) AS n_words,
         coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls
  FROM d
), g AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS n
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM m)
), c AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM g WHERE n > 1) GROUP BY doc_id
), f AS (
  SELECT m.doc_id, n_words, word_chars, n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words, len(ls) AS n_lines
  FROM m LEFT JOIN c ON m.doc_id = c.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words OR 100 * n_dup_lines > 50 * n_lines
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM f
"""

OP6 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, ws[i : i + 4] AS sh FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM d WHERE len(ws) > 0)
), z AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL
), l AS (
  SELECT x, y FROM p JOIN z u ON x = u.doc_id JOIN z v ON y = v.doc_id WHERE 100 * k >= 75 * (u.n + v.n - k)
), e AS (
  SELECT x, y FROM l UNION SELECT y, x FROM l
), r AS (
  SELECT x AS doc_id, x AS seen FROM e UNION SELECT r.doc_id, e.y FROM r JOIN e ON r.seen = e.x
), c AS (
  SELECT doc_id, min(seen) AS low FROM r GROUP BY doc_id
)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, coalesce(c.low, d.doc_id) AS component_id, coalesce(c.low, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN z ON d.doc_id = z.doc_id LEFT JOIN c ON d.doc_id = c.doc_id
"""

OP8 = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(embedding, embedding) > 0
), u AS (
  SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v
), e AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.vec_id <> b.vec_id AND list_dot_product(a.e, b.e) >= 0.9 * a.n * b.n
), r AS (
  SELECT x AS vec_id, x AS seen FROM e UNION SELECT r.vec_id, e.y FROM r JOIN e ON r.seen = e.x
), c AS (
  SELECT vec_id, min(seen) AS low FROM r GROUP BY vec_id
), k AS (
  SELECT x AS vec_id, count(*) AS n FROM e GROUP BY x
)
SELECT t.vec_id, coalesce(k.n, 0) AS n_links, coalesce(c.low, t.vec_id)::BIGINT AS component_id, coalesce(c.low, t.vec_id) = t.vec_id AS kept
FROM embeddings t LEFT JOIN k ON t.vec_id = k.vec_id LEFT JOIN c ON t.vec_id = c.vec_id
"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _canonical(column: str) -> str:
    words = f"replace(regexp_replace(lower({column}), {_text('(?m)' + licenses.COPYRIGHT_LINES)}, '', 'g'), '&', ' and ')"
    words = f"' ' || regexp_replace({words}, {_text(licenses.NOT_WORD)}, '  ', 'g') || ' '"
    for spelling, usual in licenses.SPELLINGS.items():
        words = f"replace({words}, {_text(' ' + spelling.replace(' ', '  ') + ' ')}, {_text(' ' + usual + ' ')})"
    return f"trim(regexp_replace({words}, ' +', ' ', 'g'))"


def _op10() -> str:
    rows = [("line", name, text) for name, texts in licenses.NOTICES.items() for text in texts]
    rows += [("document", name, text) for name, texts in licenses.TEXTS.items() for text in texts]
    values = ", ".join(f"({', '.join(map(_text, row))})" for row in rows)
    return f"""
WITH known AS (
  SELECT unit, sha256({_canonical("t")}) AS digest, min(license) AS license FROM (VALUES {values}) AS k(unit, license, t) GROUP BY 1, 2
), parts AS (
  SELECT doc_id, 'document' AS unit, text AS t FROM documents
  UNION ALL SELECT doc_id, 'line', unnest(string_split(text, chr(10))) FROM documents
), found AS (
  SELECT doc_id, unit, license
  FROM (SELECT doc_id, unit, sha256({_canonical("t")}) AS digest FROM parts WHERE regexp_matches(lower(t), '{licenses.ANCHOR}')) JOIN known USING (unit, digest)
), hits AS (
  SELECT doc_id, min(license) FILTER (unit = 'document') AS license, count(*) FILTER (unit = 'line') AS n_notices,
         string_agg(DISTINCT license, ',' ORDER BY license) FILTER (unit = 'line') AS notices
  FROM found GROUP BY doc_id
)
SELECT d.doc_id, license, coalesce(n_notices, 0) AS n_notices, coalesce(notices, '') AS notices FROM documents d LEFT JOIN hits h ON d.doc_id = h.doc_id
"""


def _crc32(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of a text: its reflected polynomial, byte by byte and bit by bit."""
    data = f"hex(encode({text}))"
    byte = f"list_transform(range(length({data}) // 2), lambda i: ('0x' || substr({data}, 2 * i + 1, 2))::BIGINT)"
    bits = "list_reduce(range(8), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)), xor(acc, b))"
    return f"xor(list_reduce({byte}, lambda acc, b: {bits}, 4294967295::BIGINT), 4294967295)"


OP11 = rf"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS i,
         {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS s
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, list(s ORDER BY i) AS l, {_crc32("conv_id::VARCHAR")} % 4 AS h FROM t GROUP BY conv_id
), b AS (
  SELECT c.conv_id, list_concat(coalesce(o.l, [])[1 : c.h], c.l[c.h + 1 :]) AS l FROM c LEFT JOIN c o ON o.conv_id = c.conv_id - c.conv_id % 20
), p AS (
  SELECT conv_id, len(l) = d AS ended, d, l[1 : d] AS k FROM (SELECT conv_id, l, unnest(range(0, len(l) + 1)) AS d FROM b)
), n AS (
  SELECT k, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ended), '')) AS ends_sha256,
         CASE WHEN any_value(d) = 0 THEN 0 ELSE len(regexp_extract_all(any_value(k)[-1].text, '{WORD}')) END AS words
  FROM p GROUP BY k
), u AS (
  SELECT n.*, q.conv_id AS parent_conv_id, q.k AS pk FROM n LEFT JOIN n q ON n.depth > 0 AND q.k = n.k[1 : n.depth - 1]
), m AS (
  SELECT pk, count(*) AS n_children FROM u WHERE depth > 0 GROUP BY pk
), w AS (
  SELECT u.*, coalesce(m.n_children, 0) AS n_children FROM u LEFT JOIN m ON u.k = m.pk
), s AS (
  SELECT a, sum((n_convs - 1) * words)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT n_convs, words, n_children, k[1 : x] AS a FROM (SELECT *, unnest(range(0, depth + 1)) AS x FROM w)) GROUP BY a
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 FROM w JOIN s ON w.k = s.a
"""

OP12 = rf"""
WITH RECURSIVE r AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS r FROM documents
), l AS (
  SELECT id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r FROM r WHERE length(r) >= 7
), h AS (
  SELECT r, {_crc32("id || ':' || r")} AS h FROM l
), v AS (
  SELECT word, count(*) AS n
  FROM (SELECT CASE WHEN h % 31 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word FROM h)
  WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2
), d AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)
), e AS (
  SELECT x.word AS a, y.word AS b FROM d x JOIN d y ON x.cut = y.cut AND x.i = y.i AND x.word <> y.word
  UNION SELECT x.word, v.word FROM d x JOIN v ON x.cut = v.word
  UNION SELECT v.word, x.word FROM d x JOIN v ON x.cut = v.word
), f AS (
  SELECT e.a AS word, count(*) AS n_near, min({{'o': -y.n, 'word': y.word}}) AS best FROM e JOIN v y ON e.b = y.word GROUP BY e.a
), g AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.o >= 10 * v.n THEN best END AS best FROM v LEFT JOIN f ON v.word = f.word
), w AS (
  SELECT word, best.word AS form, n, n_near, -best.o AS form_n FROM g
), c AS (
  SELECT word, word AS root, 0 AS step FROM w UNION ALL SELECT c.word, w.form, step + 1 FROM c JOIN w ON c.root = w.word WHERE w.form IS NOT NULL
), z AS (
  SELECT word, arg_max(root, step) AS root FROM c GROUP BY word
)
SELECT w.word, form, root, n, n_near, form_n FROM w JOIN z ON w.word = z.word
"""

ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP13 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{ITEM_WORD}') AS ws
  FROM documents
), b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{ITEM_WORD}') AS ws
  FROM benchmark
), i AS (
  SELECT DISTINCT item, array_to_string(ws[j : j + 9], ' ') AS w, least(10, len(ws)) AS n
  FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS j FROM b WHERE len(ws) > 0)
), p AS (
  SELECT row, j, n, array_to_string(ws[j : j + n - 1], ' ') AS w
  FROM (SELECT row, ws, n, unnest(range(1, len(ws) - n + 2)) AS j FROM d, (SELECT DISTINCT n FROM i) WHERE len(ws) >= n)
), o AS (
  SELECT row, j, p.n, item FROM p JOIN i USING (w, n)
), x AS (
  SELECT row, count(DISTINCT place) AS n_hit FROM (SELECT row, unnest(range(j, j + n)) AS place FROM o) GROUP BY row
), y AS (
  SELECT row, count(DISTINCT item) AS n_items, sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS items_sha256 FROM o GROUP BY row
)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN x ON d.row = x.row LEFT JOIN y ON d.row = y.row
"""


ORACLE: dict[str, str] = {
    "op2_quality_cascade": OP2,
    "op6_minhash_near_dedup": OP6,
    "op8_embedding_near_dedup": OP8,
    "op10_license_digests": _op10(),
    "op11_prefix_trie": OP11,
    "op12_spelling_variants": OP12,
    "op13_decontamination": OP13,
}
