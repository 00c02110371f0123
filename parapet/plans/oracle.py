"""DuckDB definitions of the fixtures, composed into oracle queries.

Each oracle query is ``with_(names...) + body``: the CTEs it needs, in
dependency order, followed by the final SELECT.
"""

from __future__ import annotations

CTES: dict[str, str] = {}
DEPS: dict[str, tuple[str, ...]] = {}


def cte(name: str, sql: str, deps: tuple[str, ...] = ()) -> None:
    CTES[name] = sql.strip()
    DEPS[name] = deps


def with_(*names: str, recursive: bool = False) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        for d in DEPS[n]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in order) + "\n"


cte("lines", """
SELECT doc_id, lang, source,
       CAST(unnest(generate_series(0, len(parts) - 1)) AS BIGINT) AS line_no,
       unnest(parts) AS line
FROM (SELECT doc_id, lang, source, string_split(text, chr(10)) AS parts FROM documents)
""")

cte("ilines", """
SELECT *, CAST(row_number() OVER (PARTITION BY lang ORDER BY doc_id, line_no) - 1 AS BIGINT) AS idx
FROM lines
""", ("lines",))

cte("zip", """
SELECT 'en__' || t.lang AS direction, s.idx, s.line AS sl, t.line AS tl
FROM ilines s JOIN ilines t ON s.idx = t.idx
WHERE s.lang = 'en' AND t.lang <> 'en'
""", ("ilines",))

cte("zip_left", """
SELECT d.direction, s.idx, s.line AS sl, coalesce(t.line, '') AS tl
FROM ilines s
CROSS JOIN (SELECT DISTINCT 'en__' || lang AS direction, lang FROM ilines WHERE lang <> 'en') d
LEFT JOIN ilines t ON t.lang = d.lang AND t.idx = s.idx
WHERE s.lang = 'en'
""", ("ilines",))

cte("tagged", """
SELECT direction, idx,
       CASE WHEN (SELECT count(DISTINCT direction) FROM zip) > 1
            THEN '<' || split_part(direction, '__', 2) || '> ' || sl ELSE sl END AS sl,
       tl
FROM zip
""", ("zip",))

cte("pairs", """
SELECT u.conv_id, u.turn, u.conv_id || '_' || u.turn AS pair_id,
       u.text AS sl, a.text AS tl
FROM conversations u JOIN conversations a
  ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant'
""")

cte("tagged_left", """
SELECT direction, idx,
       CASE WHEN (SELECT count(DISTINCT direction) FROM zip_left) > 1
            THEN '<' || split_part(direction, '__', 2) || '> ' || sl ELSE sl END AS sl,
       tl
FROM zip_left
""", ("zip_left",))

cte("corpus", """
SELECT direction, idx, CAST(row_number() OVER (ORDER BY direction, idx) - 1 AS BIGINT) AS pair_id, sl, tl
FROM tagged_left
""", ("tagged_left",))

cte("files", """
SELECT 'c' || conv_id || '_' || turn || '_Aligned.' || lang AS path, content
FROM (SELECT conv_id, turn, 'en' AS lang, sl AS content FROM pairs
      UNION ALL SELECT conv_id, turn, 'it', tl FROM pairs)
UNION ALL
SELECT 'bench_' || item_id || '.txt', text FROM benchmark
""", ("pairs",))

cte("hyp_ref", """
SELECT lang, doc_id AS sid, list_filter(r, lambda x, i: i % 7 <> 0) AS hyp, r AS ref
FROM (SELECT lang, doc_id, string_split(text, ' ') AS r FROM documents)
""")


def tokens_13a_sql(x: str) -> str:
    """The public 13a rules on an expression, as a list of tokens."""
    # fixed values: the mteval-v13a rules, in order
    rules = [("<skipped>", ""), ("-\n", ""), ("\n", " "), ("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")]
    later = [("([\\{-\\~\\[-\\` -\\&\\(-\\+\\:-\\@\\/])", " \\1 "), ("([^0-9])([\\.,])", "\\1 \\2 "),
             ("([\\.,])([^0-9])", " \\1 \\2"), ("([0-9])(-)", "\\1 \\2 "), ("\\s+", " ")]
    for a, b in rules:
        x = f"replace({x}, '{a}', '{b}')"
    x = f"' ' || {x} || ' '"
    for a, b in later:
        x = f"regexp_replace({x}, '{a}', '{b}', 'g')"
    return f"list_filter(string_split(trim({x}), ' '), lambda w: w <> '')"


cte("hyp_ref_13a", "SELECT lang, sid, " + tokens_13a_sql("array_to_string(hyp, ' ')") + " AS hyp, "
    + tokens_13a_sql("array_to_string(ref, ' ')") + " AS ref FROM hyp_ref", ("hyp_ref",))


def bleu_sql(src: str, group: str, max_n: int = 4) -> str:
    """Corpus BLEU per ``group`` over ``src(group, sid, hyp, ref)``."""
    sides = f"SELECT {group}, sid, 0 AS side, hyp AS toks FROM {src} UNION ALL " \
            f"SELECT {group}, sid, 1 AS side, ref AS toks FROM {src}"
    piv = ", ".join(f"CAST(sum(CASE WHEN n = {n} THEN correct ELSE 0 END) AS BIGINT) AS c{n}, "
                    f"CAST(sum(CASE WHEN n = {n} THEN total ELSE 0 END) AS BIGINT) AS t{n}"
                    for n in range(1, max_n + 1))
    ps, zeros = [], []
    for n in range(1, max_n + 1):
        zeros.append(f"(CASE WHEN c{n} = 0 THEN 1 ELSE 0 END)")
        k = " + ".join(zeros)
        ps.append(f"(CASE WHEN t{n} = 0 THEN 0.0 WHEN c{n} = 0 THEN 100.0 / (pow(2.0, {k}) * t{n}) "
                  f"ELSE 100.0 * c{n} / t{n} END)")
    bp = "(CASE WHEN hyp_len >= ref_len THEN 1.0 WHEN hyp_len = 0 THEN 0.0 ELSE exp(1 - ref_len / hyp_len) END)"
    anyzero = " OR ".join(f"{p} = 0" for p in ps)
    score = (f"CASE WHEN c1 = 0 OR {anyzero} THEN 0.0 ELSE {bp} * exp(("
             + " + ".join(f"ln({p})" for p in ps) + f") / {max_n}) END")
    return f"""
SELECT {group}, {score} AS bleu, {bp} AS bp,
       {", ".join(f"round({p}, 6) AS p{n + 1}" for n, p in enumerate(ps))}, hyp_len, ref_len
FROM (
  SELECT l.{group}, CAST(l.hyp_len AS BIGINT) AS hyp_len, CAST(l.ref_len AS BIGINT) AS ref_len, s.* EXCLUDE ({group})
  FROM (SELECT {group}, sum(len(hyp)) AS hyp_len, sum(len(ref)) AS ref_len FROM {src} GROUP BY {group}) l
  LEFT JOIN (
    SELECT {group}, {piv} FROM (
      SELECT {group}, n, sum(least(hc, rc)) AS correct, sum(hc) AS total FROM (
        SELECT {group}, sid, n, gram, sum(1 - side) AS hc, sum(side) AS rc FROM (
          SELECT {group}, sid, side, n, array_to_string(toks[i:i + n - 1], chr(31)) AS gram
          FROM ({sides}) s, range(1, {max_n + 1}) ns(n),
               LATERAL (SELECT unnest(generate_series(1, len(s.toks) - ns.n + 1)) AS i)
        ) GROUP BY {group}, sid, n, gram
      ) GROUP BY {group}, n
    ) GROUP BY {group}
  ) s ON s.{group} = l.{group}
)
"""

cte("logits", """
SELECT vec_id // 4 AS sid, vec_id % 4 AS model,
       CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS token_id,
       CAST(unnest(embedding) AS DOUBLE) AS logit
FROM embeddings
""")

cte("step_logits", """
SELECT vec_id // 20 AS sid, (vec_id // 4) % 5 AS step, vec_id % 4 AS model,
       CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS token_id,
       CAST(unnest(embedding) AS DOUBLE) AS logit
FROM embeddings
""")

cte("bigram_counts", """
SELECT member, prev, next, CAST(count(*) AS BIGINT) AS c FROM (
  SELECT member, toks[i] AS prev, CASE WHEN i = len(toks) THEN '</s>' ELSE toks[i + 1] END AS next
  FROM (SELECT 'm' || CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) % 4 AS member,
               list_filter(string_split(line, ' '), lambda w: w <> '') AS toks FROM lines) t,
       LATERAL (SELECT unnest(generate_series(1, len(t.toks))) AS i)
) GROUP BY member, prev, next
""", ("lines",))

cte("best_next", """
SELECT prev, next, p FROM (
  SELECT *, row_number() OVER (PARTITION BY prev ORDER BY p DESC, next) AS r FROM (
    SELECT prev, next, round(sum(p) / 4, 9) AS p FROM (
      SELECT member, prev, next, c / sum(c) OVER (PARTITION BY member, prev) AS p FROM bigram_counts)
    GROUP BY prev, next))
WHERE r = 1
""", ("bigram_counts",))

cte("starts", """
SELECT doc_id AS sid, line_no, list_filter(string_split(line, ' '), lambda w: w <> '')[1] AS token FROM lines
""", ("lines",))

# the greedy path after each context, walked token by token; ``seen`` starts with the context
cte("decode_walk", """
SELECT prev AS start, prev AS token, 0 AS step, [prev] AS seen FROM best_next
UNION ALL
SELECT d.start, b.next, d.step + 1, list_append(d.seen, b.next)
FROM decode_walk d JOIN best_next b ON b.prev = d.token
WHERE d.step < 512 AND (d.step = 0 OR d.token <> '</s>') AND NOT list_contains(d.seen, b.next)
""", ("best_next",))

cte("paths", """
SELECT w.start, w.seen[2:] AS path,
       CASE WHEN w.token = '</s>' THEN 'eos' WHEN w.step = 512 THEN 'length'
            WHEN b.prev IS NULL THEN 'dead_end' ELSE 'repeat' END AS stop
FROM (SELECT start, max(step) AS step, arg_max(token, step) AS token, arg_max(seen, step) AS seen
      FROM decode_walk GROUP BY start) w
LEFT JOIN best_next b ON b.prev = w.token
""", ("decode_walk", "best_next"))

cte("metrics", """
SELECT user_id AS run, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS epoch,
       value
FROM events
""")

# GPT-2 pre-tokens without look-ahead: a marker (chr(1)) splits the last
# white-space character off every longer white-space run that precedes a
# non-space, which is what ``\s+(?!\S)`` does; the marker is in no token.
GPT2_SQL = ("regexp_extract_all(regexp_replace({x}, '(\\s+)(\\s)(\\S)', '\\1' || chr(1) || '\\2\\3', 'g'), "
            "'''s|''t|''re|''ve|''m|''ll|''d| ?\\p{{L}}+| ?\\p{{N}}+| ?[^\\s\\p{{L}}\\p{{N}}\\x01]+|\\s+')")

cte("gpt2_words", """
SELECT word, CAST(count(*) AS BIGINT) AS cnt
FROM (SELECT unnest(""" + GPT2_SQL.format(x="line") + """) AS word FROM lines)
GROUP BY word
""", ("lines",))

cte("words", """
SELECT word, CAST(count(*) AS BIGINT) AS cnt
FROM (SELECT unnest(regexp_extract_all(text, '\\p{L}+|\\p{N}+|[^\\s\\p{L}\\p{N}]+')) AS word FROM documents)
GROUP BY word
""")

cte("word_vocab", """
SELECT CAST(row_number() OVER (ORDER BY cnt DESC, word) + 2 AS INTEGER) AS id, word FROM words
""", ("words",))

cte("pair_words", """
SELECT pair_id, side, unnest(w) AS word, CAST(generate_subscripts(w, 1) AS BIGINT) AS pos FROM (
  SELECT pair_id, 'sl' AS side, regexp_extract_all(sl, '\\p{L}+|\\p{N}+|[^\\s\\p{L}\\p{N}]+') AS w FROM pairs
  UNION ALL
  SELECT pair_id, 'tl', regexp_extract_all(tl, '\\p{L}+|\\p{N}+|[^\\s\\p{L}\\p{N}]+') FROM pairs)
""", ("pairs",))

cte("pair_ids", """
SELECT p.pair_id, p.side, coalesce(x.ids, []) AS ids
FROM (SELECT pair_id, 'sl' AS side FROM pairs UNION ALL SELECT pair_id, 'tl' FROM pairs) p
LEFT JOIN (SELECT pair_id, side, list(v.id ORDER BY w.pos) AS ids
           FROM pair_words w LEFT JOIN word_vocab v ON v.word = w.word GROUP BY pair_id, side) x
  ON x.pair_id = p.pair_id AND x.side = p.side
""", ("pairs", "pair_words", "word_vocab"))

cte("manifest", """
SELECT 'test' AS split, 'en__' || lang AS direction, source AS dataset, source || '/en' AS src,
       CASE WHEN source = 'src19' THEN NULL ELSE source || '/' || lang END AS ref
FROM (SELECT DISTINCT lang, source FROM documents WHERE lang <> 'en')
""")

cte("eval_files", """
SELECT source || '/' || lang AS path,
       CAST(row_number() OVER (PARTITION BY source, lang ORDER BY doc_id, line_no) - 1 AS BIGINT) AS line_no, line
FROM lines
""", ("lines",))

cte("eval_sets", """
SELECT m.direction, m.dataset, s.line_no, s.line AS src,
       CASE WHEN m.ref IS NULL THEN NULL ELSE coalesce(r.line, '') END AS ref
FROM manifest m JOIN eval_files s ON s.path = m.src
LEFT JOIN eval_files r ON r.path = m.ref AND r.line_no = s.line_no
""", ("manifest", "eval_files"))

cte("translations", """
SELECT e.direction, e.dataset, e.line_no, e.src, e.ref,
       coalesce(array_to_string(list_filter(p.path, lambda t: t <> '</s>'), ' '), '') AS hypothesis,
       CAST(coalesce(len(p.path), 0) AS BIGINT) AS n_steps,
       CASE WHEN len(list_filter(string_split(e.src, ' '), lambda w: w <> '')) = 0 THEN 'empty'
            ELSE coalesce(p.stop, 'dead_end') END AS stop
FROM eval_sets e
LEFT JOIN paths p ON p.start = list_filter(string_split(e.src, ' '), lambda w: w <> '')[1]
""", ("eval_sets", "paths"))

cte("eval_hr", """
SELECT direction || '/' || dataset AS evalset, line_no AS sid,
       list_filter(string_split(hypothesis, ' '), lambda w: w <> '') AS hyp,
       list_filter(string_split(ref, ' '), lambda w: w <> '') AS ref
FROM translations WHERE ref IS NOT NULL
""", ("translations",))
