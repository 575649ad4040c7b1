"""The queries in SQL, written independently, for a second engine.

There is none for what is learned: languages, quality, pages, and the pipeline
that begins with languages.
"""

from __future__ import annotations

import string

from .license_scan import BASE, NOTICES, words_of

ORACLES: dict[str, str] = {}

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
_WORD = r"'[^\x20\x09-\x0D]+'"
_SHINGLES = """CASE WHEN len(words) >= 5
    THEN list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i+4], ' '))
    WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END"""


def _shingled(table: str, key: str) -> str:
    return f"""SELECT {key}, {_SHINGLES} AS sh
  FROM (SELECT {key}, regexp_extract_all({_LOWER}, {_WORD}) AS words FROM {table})"""


ORACLES["op1_near_dedup"] = f"""
WITH RECURSIVE docs AS MATERIALIZED ({_shingled("documents", "doc_id")}),
sets AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(sh) AS s FROM docs),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both
  FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * n_both >= 75 * (x.n + y.n - n_both)),
ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT ways.b, reach.other FROM reach JOIN ways ON ways.a = reach.doc_id)
SELECT d.doc_id, CAST(coalesce(z.n, 0) AS BIGINT) AS n_shingles, c.component_id,
  d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN sizes z USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
"""

_WHITE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
ORACLES["op2_line_dedup"] = f"""
WITH split AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS MATERIALIZED (
  SELECT *, translate(trim(line, {_WHITE}), '{string.ascii_uppercase}',
                      '{string.ascii_lowercase}') AS key FROM split),
common AS (
  SELECT key FROM keyed WHERE length(key) >= 1
  GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT k.doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
  sha256(coalesce(string_agg(k.line, chr(10) ORDER BY pos) FILTER (c.key IS NULL), ''))
    AS kept_sha256
FROM keyed k LEFT JOIN common c ON c.key = k.key GROUP BY k.doc_id
"""


def _templates() -> str:
    rows = []
    for number, one in enumerate((*BASE, *NOTICES)):
        words = [w.decode() for w in words_of(one.text)]
        need = -(-one.percent * len(set(words)) // 100)
        listed = ", ".join(f"'{w}'" for w in words)
        rows.append(
            f"({number}, '{one.label}', [{listed}], {need}, {one.phrase}, {number < len(BASE)})"
        )
    return ", ".join(rows)


ORACLES["op3_license_scan"] = rf"""
WITH templates(t, label, parts, need, phrase, base) AS (VALUES {_templates()}),
tokens AS (SELECT DISTINCT t, unnest(parts) AS word FROM templates),
docs AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
places AS MATERIALIZED (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS pos,
    len(words) AS n FROM docs),
shared AS (
  SELECT doc_id, t, word, len(parts) AS width, n,
    unnest(range(greatest(0, pos - len(parts) + 1),
                 greatest(0, least(pos, n - len(parts))) + 1)) AS start
  FROM places JOIN tokens USING (word) JOIN templates USING (t)),
blocks AS (
  SELECT doc_id, t, start, count(DISTINCT word) AS common
  FROM shared GROUP BY doc_id, t, start),
met AS (
  SELECT b.*, t.label, t.base, common / len(list_distinct(parts)) AS share
  FROM blocks b JOIN templates t USING (t) JOIN docs d USING (doc_id)
  WHERE common >= need
    AND (NOT phrase OR list_slice(d.words, start + 1, start + len(parts)) = parts))
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, count(start) FILTER (base) AS n_base,
  CAST(min(start) FILTER (base) AS BIGINT) AS first_word,
  CAST(max(start) FILTER (base) AS BIGINT) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels,
  coalesce(max(share), 0.0) AS score
FROM docs d LEFT JOIN met USING (doc_id) GROUP BY d.doc_id, d.words
"""

ORACLES["op7_sharding"] = """
WITH sizes AS (
  SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n_bytes,
    CAST('0x' || left(md5(CAST(doc_id AS VARCHAR)), 15) AS BIGINT) AS h FROM documents),
depths AS (SELECT CAST(unnest(range(0, 31)) AS INTEGER) AS depth),
prefixes AS (
  SELECT depth, h >> (60 - depth) AS prefix, sum(n_bytes) AS total
  FROM sizes, depths GROUP BY ALL),
chosen AS (
  SELECT doc_id, n_bytes, h, min(depth) AS depth
  FROM sizes, depths JOIN prefixes USING (depth)
  WHERE prefix = h >> (60 - depth) AND total <= 1048576 GROUP BY doc_id, n_bytes, h)
SELECT doc_id, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(h >> (60 - depth)), depth, '0') END
  AS shard, depth AS shard_depth, n_bytes FROM chosen
"""


def _mixing() -> str:
    dims = ("source", "lang", "topic")
    ctes = [
        f"""docs AS MATERIALIZED (
  SELECT doc_id, source, lang,
    CASE WHEN len(regexp_extract_all(x, '\\|')) * 50 > length(x) THEN 'table'
         WHEN len(regexp_extract_all(x, '[#*$%&]')) * 20 > length(x) THEN 'symbols'
         WHEN len(regexp_extract_all(x, '[A-Z]')) * 4 > length(x) THEN 'shout'
         ELSE 'prose' END AS topic,
    greatest(len(regexp_extract_all(x, {_WORD})), 1) AS n_tokens,
    CAST('0x' || left(md5('mix' || doc_id), 12) AS BIGINT) / CAST(1::BIGINT << 48 AS DOUBLE) AS u
  FROM (SELECT *, coalesce(text, '') AS x FROM documents))""",
        """cells AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY source, lang, topic) AS i
  FROM (SELECT source, lang, topic, sum(n_tokens) AS tokens FROM docs GROUP BY ALL))""",
    ]
    for d in dims:
        ctes.append(f"""values_{d} AS MATERIALIZED (
  SELECT value, row_number() OVER (ORDER BY value) AS v, sqrt(n) / sum(sqrt(n)) OVER () AS target
  FROM (SELECT {d} AS value, sum(tokens) AS n FROM cells GROUP BY 1))""")
    joins = "".join(f" JOIN values_{d} v{d} ON v{d}.value IS NOT DISTINCT FROM {d}" for d in dims)
    at = "".join(f", list(v{d}.v ORDER BY i) AS at_{d}" for d in dims)
    goals = "".join(f", (SELECT list(target ORDER BY v) FROM values_{d}) AS to_{d}" for d in dims)
    ctes.append(f"""base AS MATERIALIZED (
  SELECT list(CAST(tokens AS DOUBLE) ORDER BY i) AS w{at}{goals} FROM cells{joins})""")
    source, errors = "raking CROSS JOIN (SELECT * EXCLUDE (w) FROM base)", []
    for d in dims:
        source = f"""(SELECT *, list_transform(range(1, len(to_{d}) + 1), lambda v: list_sum(list_transform(
      w, lambda x, i: CASE WHEN at_{d}[i] = v THEN x ELSE 0 END))) AS sum_{d} FROM {source})"""
        source = f"""(SELECT * REPLACE (
      list_transform(w, lambda x, i: x * to_{d}[at_{d}[i]] / sum_{d}[at_{d}[i]]) AS w) FROM {source})"""
        errors.append(f"list_max(list_transform(sum_{d}, lambda s, v: abs(s / to_{d}[v] - 1)))")
    ctes.append(f"""raking(k, error, w) AS (
  SELECT 0, CAST(1 AS DOUBLE), w FROM base
  UNION ALL SELECT k + 1, greatest({", ".join(errors)}), w FROM {source} WHERE error > 1e-7)""")
    ctes.append("""raked AS MATERIALIZED (
  SELECT source, lang, topic, tokens, w[i] AS weight, w[i] / tokens AS ratio
  FROM cells, (SELECT arg_max(w, k) AS w FROM raking))""")
    ctes.append("""scale AS (
  SELECT arg_max(c, (ratio, below)) AS c FROM (
    SELECT ratio, below, (0.5 * whole - (whole - below)) / share AS c FROM (
      SELECT ratio, sum(tokens) OVER () AS whole,
        sum(tokens) OVER (ORDER BY ratio ROWS UNBOUNDED PRECEDING) AS below,
        sum(weight) OVER (ORDER BY ratio ROWS UNBOUNDED PRECEDING) AS share FROM raked))
  WHERE ratio * c < 1)""")
    return f"""
WITH RECURSIVE {", ".join(ctes)}
SELECT doc_id, CAST(n_tokens AS BIGINT) AS n_tokens, round(p, 4) AS probability, u < p AS kept
FROM (SELECT d.*, least(1.0, ratio * coalesce(c, 1e300)) AS p
      FROM docs d JOIN raked r ON r.source IS NOT DISTINCT FROM d.source
        AND r.lang IS NOT DISTINCT FROM d.lang AND r.topic = d.topic, scale)
"""


ORACLES["op9_mixing"] = _mixing()

ORACLES["op10_decontamination"] = f"""
WITH docs AS MATERIALIZED ({_shingled("documents", "doc_id")}),
items AS MATERIALIZED (
  SELECT * FROM ({_shingled("benchmark", "item_id")}) WHERE len(sh) > 0),
in_docs AS MATERIALIZED (
  SELECT doc_id, len(sh) AS n, unnest(sh) AS s, generate_subscripts(sh, 1) - 1 AS pos FROM docs),
in_items AS MATERIALIZED (
  SELECT item_id, len(sh) AS m, unnest(sh) AS s, generate_subscripts(sh, 1) - 1 AS pos
  FROM items),
starts AS MATERIALIZED (
  SELECT DISTINCT d.doc_id, i.m, greatest(0, least(d.pos - i.pos, d.n - i.m)) AS start
  FROM in_docs d JOIN in_items i USING (s)),
in_windows AS MATERIALIZED (
  SELECT w.doc_id, w.m, w.start, d.s, count(*) AS n
  FROM starts w JOIN in_docs d ON d.doc_id = w.doc_id AND d.pos >= w.start
    AND d.pos < w.start + w.m GROUP BY ALL),
sizes AS (SELECT doc_id, m, start, sum(n) AS size FROM in_windows GROUP BY ALL),
counted AS (SELECT item_id, m, s, count(*) AS n FROM in_items GROUP BY ALL),
scored AS (
  SELECT w.doc_id, i.item_id, w.start, CAST(sum(least(w.n, i.n)) AS BIGINT) AS n_common,
    CAST(any_value(z.size) + w.m - sum(least(w.n, i.n)) AS BIGINT) AS n_union
  FROM in_windows w JOIN counted i ON i.s = w.s AND i.m = w.m
  JOIN sizes z ON z.doc_id = w.doc_id AND z.m = w.m AND z.start = w.start
  GROUP BY w.doc_id, i.item_id, w.start, w.m)
SELECT DISTINCT ON (doc_id, item_id) doc_id, item_id, CAST(start AS BIGINT) AS start, n_common,
  n_union, n_common / n_union AS similarity
FROM scored WHERE 100 * n_common >= 75 * n_union
ORDER BY doc_id, item_id, n_common / n_union DESC, start
"""

_FIELDS = " || ".join(
    f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')"
    for c in ("doc_id", "source", "lang", "n_chars{more}", "text")
)


def _tree(level: str) -> str:
    """The levels above the lists of ``level (tree, level, nodes)``, one row each."""
    return f"""SELECT tree, CAST(0 AS BIGINT) AS level, nodes FROM {level}
  UNION ALL
  SELECT tree, level + 1, list_transform(range(1, len(nodes) + 1, 2),
    lambda i: sha256(nodes[i] || coalesce(nodes[i + 1], '')))
  FROM {level}s WHERE len(nodes) > 1"""


ORACLES["op11_merkle_manifest"] = f"""
WITH RECURSIVE hashed AS MATERIALIZED (
  SELECT doc_id, lang, sha256({_FIELDS.format(more="")}) AS leaf,
    sha256({_FIELDS.format(more=" + 1")}) AS changed FROM documents),
crcs(k, c) AS (
  SELECT k, CAST(k AS UBIGINT) FROM range(256) t(k)),
bytes AS MATERIALIZED (
  SELECT k, list_reduce(list_prepend(c, range(8)), lambda x, _:
    CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END) AS c FROM crcs),
codes AS MATERIALIZED (SELECT list(c ORDER BY k) AS codes FROM bytes),
placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    dense_rank() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS tree,
    xor(list_reduce(list_prepend(4294967295::UBIGINT,
      list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS UBIGINT))),
      lambda x, b: xor(x >> 8, codes[CAST(xor(x & 255, b) + 1 AS BIGINT)])), 4294967295::UBIGINT) AS crc
  FROM hashed, codes),
low AS MATERIALIZED (SELECT tree, list(leaf ORDER BY pos) AS nodes FROM placed GROUP BY tree),
lows AS ({_tree("low")}),
levels AS MATERIALIZED (SELECT * FROM lows),
subroots AS MATERIALIZED (SELECT tree, nodes[1] AS subroot FROM levels WHERE len(nodes) = 1),
top AS MATERIALIZED (SELECT 0 AS tree, list(subroot ORDER BY tree) AS nodes FROM subroots),
tops AS ({_tree("top")}),
above AS MATERIALIZED (SELECT * FROM tops),
steps AS MATERIALIZED (
  SELECT leaf_of.tree, leaf_of.pos, level AS step, (leaf_of.pos >> level) & 1 AS side,
    nodes[xor(leaf_of.pos >> level, 1) + 1] AS sibling
  FROM placed leaf_of JOIN levels USING (tree) WHERE len(nodes) > 1
  UNION ALL
  SELECT p.tree, p.pos, 64 + level, (p.tree >> level) & 1, nodes[xor(p.tree >> level, 1) + 1]
  FROM placed p, above WHERE len(nodes) > 1),
ways AS MATERIALIZED (
  SELECT tree, pos, sha256(coalesce(string_agg(sibling, '' ORDER BY step), '')) AS proof_sha256,
    list({{'side': side, 'sibling': sibling}} ORDER BY step) AS way
  FROM placed LEFT JOIN steps USING (tree, pos) GROUP BY tree, pos),
folds(tree, pos, k, digest) AS (
  SELECT tree, pos, 1, CASE WHEN coalesce(crc % 7 = 0, false) THEN changed ELSE leaf END FROM placed
  UNION ALL
  SELECT f.tree, f.pos, k + 1, CASE WHEN way[k].side = 1
      THEN sha256(coalesce(way[k].sibling, '') || digest)
      ELSE sha256(digest || coalesce(way[k].sibling, '')) END
  FROM folds f JOIN ways USING (tree, pos) WHERE k <= len(way) AND way[k].side IS NOT NULL),
folded AS (SELECT tree, pos, arg_max(digest, k) AS folded_root FROM folds GROUP BY tree, pos)
SELECT doc_id, leaf, subroot, r.nodes[1] AS root, proof_sha256, folded_root,
  folded_root = r.nodes[1] AS verified
FROM placed JOIN subroots USING (tree) JOIN ways USING (tree, pos) JOIN folded USING (tree, pos),
  (SELECT nodes FROM above WHERE len(nodes) = 1) r
"""

ORACLES["op13_lexical_search"] = rf"""
WITH words AS MATERIALIZED (
  SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
items AS MATERIALIZED (
  SELECT DISTINCT item_id,
    unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
lengths AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
whole AS MATERIALIZED (
  SELECT count(*) AS n_docs, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_all FROM lengths),
times AS MATERIALIZED (
  SELECT doc_id, term, count(*) AS tf FROM words
  WHERE term IN (SELECT term FROM items) GROUP BY ALL),
weights AS MATERIALIZED (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM times, whole GROUP BY term, n_docs),
scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf)
    // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_all)))) AS BIGINT) AS score
  FROM items JOIN times USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), whole
  GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
      FROM scores WHERE score > 0)
WHERE rank <= 10
"""
