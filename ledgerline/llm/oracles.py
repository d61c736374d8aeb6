"""The registered queries as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from ledgerline.llm.licenses import PHRASES, TEMPLATES, parse_template

_WORDS = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT doc_id, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM texts
),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS s FROM words),
windows AS (SELECT doc_id, s, list_slice(w, s, s + 34) AS part FROM starts),
repeated AS (SELECT doc_id, s, count(*) OVER (PARTITION BY part) AS n FROM windows),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS i FROM repeated WHERE n > 1),
placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words),
kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY i) AS kept
  FROM placed ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n_kept, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

_BYTES = r"""
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS s FROM texts),
windows AS (SELECT doc_id, s, substr(h, 2 * s + 1, 100) AS part FROM starts),
later AS (SELECT doc_id, s, doc_id > min(doc_id) OVER (PARTITION BY part) AS goes FROM windows),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS i FROM later WHERE goes),
runs AS (SELECT doc_id, count(*) AS n, count(*) FILTER (i - 1 IS DISTINCT FROM before) AS n_spans
         FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM gone) GROUP BY doc_id),
placed AS (SELECT doc_id, h, unnest(range(0, len(h) // 2)) AS i FROM texts),
kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * i + 1, 2), '' ORDER BY i) AS kept
  FROM placed ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM texts LEFT JOIN runs USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

_LATTICE = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.93
),
reached AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
),
smallest AS (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id)::BIGINT AS n_links, component_id,
       e.vec_id = component_id AS kept
FROM embeddings e JOIN smallest USING (vec_id)
"""

_CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
sized AS (
  SELECT *, length(role) + length(regexp_replace(role, '[^\\\n:]', '', 'g')) + length(text)
    + len(regexp_extract_all(text, '(?m)^\\*### ')) + len(regexp_extract_all(text, '</turn>')) + 15 AS size
  FROM turns
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(size)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

_MERKLE = """
WITH RECURSIVE fields AS (
  SELECT doc_id, lang,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    n_chars, coalesce(strlen(text) || ':' || text, '-') AS tail,
    list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
      lambda c, d: list_reduce(
        list_prepend(xor(c, d), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda r, z: xor(r >> 1, (r & 1) * 3988292384))) AS register
  FROM documents
),
hashed AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || coalesce(strlen((n_chars + t)::VARCHAR) || ':' || (n_chars + t), '-') || tail) AS changed
  FROM (SELECT *, CASE WHEN xor(register, 4294967295) % 7 = 0 THEN 1 ELSE 0 END AS t FROM fields)
),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM hashed
),
grown AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY place) AS nodes FROM leaves GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, list_transform(range(0, (len(nodes) + 1) // 2),
    lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
  FROM grown WHERE len(nodes) > 1
),
subroots AS (
  SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS rank
  FROM grown WHERE len(nodes) = 1
),
over_grown AS (
  SELECT 0 AS level, list(subroot ORDER BY rank) AS nodes FROM subroots
  UNION ALL
  SELECT level + 1, list_transform(range(0, (len(nodes) + 1) // 2),
    lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
  FROM over_grown WHERE len(nodes) > 1
),
steps AS (
  SELECT l.doc_id, l.lang, l.place, g.level, (l.place >> g.level) & 1 AS side,
    g.nodes[xor(l.place >> g.level, 1) + 1] AS sibling
  FROM leaves l JOIN grown g ON l.lang IS NOT DISTINCT FROM g.lang AND len(g.nodes) > 1
  UNION ALL
  SELECT l.doc_id, l.lang, l.place, 100 + o.level, (s.rank >> o.level) & 1, o.nodes[xor(s.rank >> o.level, 1) + 1]
  FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang JOIN over_grown o ON len(o.nodes) > 1
),
paths AS (
  SELECT lang, place, string_agg(coalesce(sibling, ''), '' ORDER BY level) AS siblings,
    list(CASE WHEN sibling IS NULL THEN '-' WHEN side = 1 THEN 'L' || sibling ELSE 'R' || sibling END ORDER BY level) AS path
  FROM steps GROUP BY lang, place
),
folded AS (
  SELECT l.doc_id, l.leaf, s.subroot, (SELECT nodes[1] FROM over_grown WHERE len(nodes) = 1) AS root,
    sha256(coalesce(p.siblings, '')) AS proof_sha256,
    list_reduce(list_prepend(l.changed, coalesce(p.path, [])), lambda h, x: sha256(
      CASE x[1] WHEN 'L' THEN x[2:] || h WHEN 'R' THEN h || x[2:] ELSE h END)) AS folded_root
  FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang
    LEFT JOIN paths p ON l.lang IS NOT DISTINCT FROM p.lang AND l.place = p.place
)
SELECT *, folded_root = root AS verified FROM folded
"""



def _pattern(parts: list) -> str:
    """A template's parts as a pattern over words that each end in a space."""
    out = ""
    for part in parts:
        if isinstance(part, bytes):
            out += part.decode() + " "
        elif part[0] == "optional":
            out += f"({_pattern(part[1])})?"
        else:
            out += f"([^ ]+ ){{{part[1]},{part[2]}}}"
    return out


_RULES = ", ".join(
    f"('{label}', {base}, '{markup.split()[0]}', '^{_pattern(parse_template(markup))}')"
    for base, entries in (("true", PHRASES), ("false", TEMPLATES))
    for label, markup in entries
)
_LICENSES = rf"""
WITH rules(label, base, opening, pattern) AS (VALUES {_RULES}),
words AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM documents
),
starts AS (
  SELECT doc_id, s, w[s + 1] AS opening, list_slice(w, s + 1, s + 80) AS rest
  FROM (SELECT doc_id, w, unnest(range(0, len(w))) AS s FROM words)
),
met AS (
  SELECT doc_id, s, label, base, regexp_extract(array_to_string(rest, ' ') || ' ', pattern) AS wording
  FROM starts JOIN rules USING (opening)
),
places AS (
  SELECT doc_id, s, label, base, len(wording) - len(replace(wording, ' ', '')) AS n FROM met WHERE wording <> ''
),
lying AS (SELECT DISTINCT doc_id, unnest(range(s, s + n)) AS i FROM places),
found AS (
  SELECT doc_id, count(*) FILTER (base) AS n_base, min(s) FILTER (base) AS first_word, max(s) FILTER (base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM places GROUP BY doc_id
),
covered AS (SELECT doc_id, count(*) AS n_covered FROM lying GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(n_covered / len(w), 0)::DOUBLE AS score
FROM words LEFT JOIN found USING (doc_id) LEFT JOIN covered USING (doc_id)
"""



def _codes(rounds: int) -> str:
    """Products are exact: the squares of these integers add up to less than 2^53."""

    def assigned(k: int) -> str:
        return f"""
a{k} AS (
  SELECT vec_id, label, p, any_value(x.part) AS part,
    min((list_dot_product(x.part, x.part) - 2 * list_dot_product(x.part, c.part)
         + list_dot_product(c.part, c.part))::BIGINT * 256 + e) AS best
  FROM parts x JOIN c{k} c USING (p) GROUP BY vec_id, label, p
)"""

    def replaced(k: int) -> str:
        return f"""
m{k} AS (
  SELECT p, best % 256 AS e, i, sum(part[i + 1]::BIGINT)::BIGINT AS total, count(*) AS n
  FROM (SELECT p, best, part, unnest(range(0, len(part))) AS i FROM a{k}) GROUP BY ALL
),
n{k} AS (SELECT p, e, list(((total - ((total % n) + n) % n) // n)::DOUBLE ORDER BY i) AS part FROM m{k} GROUP BY p, e),
c{k + 1} AS (SELECT p, e, coalesce(n.part, c.part) AS part FROM c{k} c LEFT JOIN n{k} n USING (p, e))"""

    steps = ",".join(f"{assigned(k)},{replaced(k)}" for k in range(rounds))
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
),
parts AS (
  SELECT vec_id, label, p, list_slice(v, p * len(v) // 4 + 1, (p + 1) * len(v) // 4) AS part
  FROM kept, range(0, 4) AS r(p)
),
c0 AS (
  SELECT p, e, part
  FROM (SELECT p, part, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM parts) WHERE e < 256
),{steps},{assigned(rounds)},
coded AS (
  SELECT vec_id, label, string_agg(lower(lpad(to_hex(best % 256), 2, '0')), '' ORDER BY p) AS code,
    sum(best // 256)::BIGINT AS error
  FROM a{rounds} GROUP BY vec_id, label
),
books AS (
  SELECT sha256(string_agg(value::BIGINT::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256
  FROM (SELECT p, e, unnest(range(0, len(part))) AS i, unnest(part) AS value FROM c{rounds})
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded, books
"""


ORACLES = {
    "op1_chat": _CHAT,
    "op2_repeated_words": _WORDS,
    "op7_repeated_bytes": _BYTES,
    "op10_lattice": _LATTICE,
    "op11_merkle": _MERKLE,
    "op12_licenses": _LICENSES,
    "op13_codes": _codes(4),
}
