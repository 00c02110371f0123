"""Ensemble queries: log-softmax, vocabulary cut, last position, arg-max,
member availability, probability averaging and the full ensemble step."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import functions as F

from parapet.functions import text as T
from parapet.operators import decode, ensemble as ens, scorers
from parapet.plans import fixtures as fx, queries_vocab as qv
from parapet.plans.catalog import query
from parapet.plans.oracle import with_
from parapet.sources import members
from parapet.sources.cache import artefact_root, materialise_once

K = 10                                    # vocabulary cut of F8
DECLARED = ["0", "1", "2", "3", "4"]      # configured members; one never scores


def _lsm_sql(src: str, keys: str, where: str = "") -> str:
    return f"""
SELECT {keys}, token_id, round(logit - mx - ln(se), 6) AS lp FROM (
  SELECT *, sum(exp(logit - mx)) OVER (PARTITION BY {keys}) AS se FROM (
    SELECT *, max(logit) OVER (PARTITION BY {keys}) AS mx FROM {src} {where}))
"""


@query("log_softmax", with_("logits") + _lsm_sql("logits", "sid, model"))
def log_softmax(spark, sf):
    lg = fx.logits(spark, sf)
    return lg.select("sid", "model", F.posexplode(ens.log_softmax("logits")).alias("token_id", "lp")) \
             .select("sid", "model", F.col("token_id").cast("bigint"), F.round("lp", 6).alias("lp"))


@query("vocab_limit", with_("logits") + _lsm_sql("logits", "sid, model", f"WHERE token_id < {K}"))
def vocab_limit(spark, sf):
    lg = fx.logits(spark, sf)
    return lg.select("sid", "model",
                     F.posexplode(ens.log_softmax(ens.vocab_limit("logits", K))).alias("token_id", "lp")) \
             .select("sid", "model", F.col("token_id").cast("bigint"), F.round("lp", 6).alias("lp"))


@query("last_position", with_("step_logits") + """
SELECT sid, model, step, round(sum(logit), 6) AS logit_sum FROM step_logits s
WHERE step = (SELECT max(step) FROM step_logits t WHERE t.sid = s.sid AND t.model = s.model)
GROUP BY sid, model, step
""")
def last_position(spark, sf):
    last = ens.last_position(fx.step_logits(spark, sf), ["sid", "model"], "step", "logits")
    return last.select("sid", "model", "step",
                       F.round(F.aggregate("logits", F.lit(0.0), lambda s, x: s + x), 6).alias("logit_sum"))


@query("argmax", with_("logits") + """
SELECT sid, model, token_id FROM (
  SELECT *, row_number() OVER (PARTITION BY sid, model ORDER BY logit DESC, token_id) AS r FROM logits)
WHERE r = 1
""")
def argmax(spark, sf):
    return fx.logits(spark, sf).select("sid", "model", ens.argmax("logits").alias("token_id"))


_MEMBERS_SQL = "SELECT * FROM (VALUES " + ", ".join(f"('{m}')" for m in DECLARED) + ") v(model)"


@query("available_models", with_("logits") + f"""
SELECT coalesce(d.model, s.model) AS model, CAST(coalesce(s.n, 0) AS BIGINT) AS n_rows,
       coalesce(s.n, 0) > 0 AS available
FROM ({_MEMBERS_SQL}) d
FULL OUTER JOIN (SELECT CAST(model AS VARCHAR) AS model, count(DISTINCT sid) AS n FROM logits GROUP BY 1) s
  ON s.model = d.model
""")
def available_models(spark, sf):
    return ens.available_members(fx.logits(spark, sf), DECLARED).select("model", "n_rows", "available")


_AVG_SQL = """
lp AS (
  SELECT sid, model, token_id, logit - mx - ln(se) AS lp FROM (
    SELECT *, sum(exp(logit - mx)) OVER (PARTITION BY sid, model) AS se FROM (
      SELECT *, max(logit) OVER (PARTITION BY sid, model) AS mx FROM {src}))
),
m AS (SELECT count(DISTINCT model) AS m FROM {src}),
avg AS (
  SELECT sid, token_id, mx + ln(sum(exp(lp - mx))) - ln((SELECT m FROM m)) AS avg_lp FROM (
    SELECT *, max(lp) OVER (PARTITION BY sid, token_id) AS mx FROM lp)
  GROUP BY sid, token_id, mx
)
"""


@query("ensemble_average", with_("logits") + ", " + _AVG_SQL.format(src="logits") + """
SELECT sid, token_id, round(avg_lp, 6) AS avg_lp FROM avg
""")
def ensemble_average(spark, sf):
    lg = fx.logits(spark, sf)
    m = lg.select(F.count_distinct("model")).scalar()
    lp = lg.select("sid", "model", ens.log_softmax("logits").alias("lp"))
    avg = ens.ensemble_average(lp, ["sid"], "lp", m)
    return avg.select("sid", F.posexplode("avg_logprobs").alias("token_id", "avg_lp")) \
              .select("sid", F.col("token_id").cast("bigint"), F.round("avg_lp", 6).alias("avg_lp"))


@query("ensemble_step", with_("step_logits") + """, last AS (
  SELECT sid, model, token_id, logit FROM step_logits s
  WHERE step = (SELECT max(step) FROM step_logits t WHERE t.sid = s.sid AND t.model = s.model)
), """ + _AVG_SQL.format(src="last") + """
SELECT sid, token_id, round(avg_lp, 6) AS logprob FROM (
  SELECT *, row_number() OVER (PARTITION BY sid ORDER BY avg_lp DESC, token_id) AS r FROM avg)
WHERE r = 1
""")
def ensemble_step(spark, sf):
    sl = fx.step_logits(spark, sf)
    available = ens.require_members(ens.available_members(sl, DECLARED))
    out = ens.ensemble_step(sl.filter(F.col("model").cast("string").isin(available)),
                            ["sid"], "step", "model", "logits", len(available))
    return out.select("sid", "token_id", F.round("logprob", 6).alias("logprob"))


OPAQUE_DIGITS = 9
OPAQUE_MEMBERS = fx.BIGRAM_MEMBERS


def _opaque_members(n: int):
    """Opaque scorers over all ``n`` ids: softmax of log(1 + count)."""
    def score(count, total):
        return np.log1p(count) - np.log(n + total)
    return [score] * len(OPAQUE_MEMBERS)


def _opaque_paths(spark, sf):
    """(prev, path, stop) after the first word of every line, materialised once per input."""
    def build():
        cells, totals = fx.bigram_cells(spark, sf, decode.opaque_near_best(_opaque_members, OPAQUE_DIGITS))
        best = decode.opaque_best_next(cells, totals, _opaque_members, OPAQUE_DIGITS)
        return decode.greedy_paths(best, starts=fx.decode_starts(spark, sf))
    key = [fx.documents_key(spark, sf), fx.N_MEMBERS, "opaque", OPAQUE_DIGITS, decode.MAX_STEPS]
    return materialise_once(spark, "opaque-paths", key, build)


_OPAQUE_SQL = f""",
wn AS (SELECT count(DISTINCT prev) + 1 AS n FROM bigram_counts),
wt AS (SELECT member, prev, sum(c) AS t FROM bigram_counts GROUP BY member, prev),
wm AS (SELECT DISTINCT member FROM bigram_counts),
wa AS (
  SELECT s.prev, s.next, round(ln(sum((1 + coalesce(b.c, 0)) / (n + coalesce(t.t, 0)))) - ln(count(*)), {OPAQUE_DIGITS}) AS a
  FROM (SELECT DISTINCT prev, next FROM bigram_counts) s CROSS JOIN wm CROSS JOIN wn
  LEFT JOIN bigram_counts b ON b.member = wm.member AND b.prev = s.prev AND b.next = s.next
  LEFT JOIN wt t ON t.member = wm.member AND t.prev = s.prev
  GROUP BY s.prev, s.next
), wb AS (
  SELECT prev, next FROM (SELECT *, row_number() OVER (PARTITION BY prev ORDER BY a DESC, next) AS r FROM wa) WHERE r = 1
), ww AS (
  SELECT prev AS start, prev AS token, 0 AS step, [prev] AS seen FROM wb
  UNION ALL
  SELECT d.start, b.next, d.step + 1, list_append(d.seen, b.next)
  FROM ww d JOIN wb b ON b.prev = d.token
  WHERE d.step < {decode.MAX_STEPS} AND (d.step = 0 OR d.token <> '</s>') AND NOT list_contains(d.seen, b.next)
), wp AS (
  SELECT w.start, w.seen[2:] AS path,
         CASE WHEN w.token = '</s>' THEN 'eos' WHEN w.step = {decode.MAX_STEPS} THEN 'length'
              WHEN b.prev IS NULL THEN 'dead_end' ELSE 'repeat' END AS stop
  FROM (SELECT start, max(step) AS step, arg_max(token, step) AS token, arg_max(seen, step) AS seen
        FROM ww GROUP BY start) w
  LEFT JOIN wb b ON b.prev = w.token
)
SELECT s.sid, s.line_no, coalesce(array_to_string(list_filter(p.path, lambda t: t <> '</s>'), ' '), '') AS hypothesis,
       CAST(coalesce(len(p.path), 0) AS BIGINT) AS n_steps,
       CASE WHEN s.token IS NULL THEN 'empty' ELSE coalesce(p.stop, 'dead_end') END AS stop
FROM starts s LEFT JOIN wp p ON p.start = s.token
"""


@query("opaque_decode", with_("bigram_counts", "starts", recursive=True) + _OPAQUE_SQL)
def opaque_decode(spark, sf):
    """E1/E4 with opaque scorers (X3) over the whole vocabulary: each line is
    decoded from its own first word to the end, a repeated word or the model's
    limit, and says which."""
    keys = ["sid", "line_no"]
    return decode.decoded_text(decode.greedy_decode(fx.decode_starts(spark, sf), _opaque_paths(spark, sf), keys), keys=keys)


SUCCESSORS = 8          # listed successors of an id: the members' size
MEMBER_WEIGHTS = {"0": (2.0, 0.5), "1": (4.0, 1.0), "2": (3.0, 0.5), "3": (2.0, 2.0)}       # of source and prefix


def _member_files(spark, sf):
    """(model, path) of the declared members: those fitted on the target
    lines of the train split, and one that has no file."""
    model, _, enc = qv._encoded_corpus(spark, sf)
    ids, n = {t: i for i, t in enumerate(model.specials)}, len(MEMBER_WEIGHTS)
    targets = enc.filter("split = 'train' and side = 'tl' and size(ids) > 0").select((F.col("pair_id") % n).cast("string").alias("member"), "ids")
    key = [fx.documents_key(spark, sf), qv.VOCAB_SIZE, qv.SEED, qv.N_VALID, n, SUCCESSORS]

    def build():
        fitted = scorers.successor_counts(targets, "member", "ids", ids[T.BOS], ids[T.EOS], SUCCESSORS)
        return members.save_members(fitted, f"{artefact_root(spark)}/members-{uuid.uuid4().hex}")

    saved = materialise_once(spark, "member-files", key, build)
    declared = spark.createDataFrame([(m,) for m in DECLARED], "model string")
    return declared.join(saved, "model", "left").select("model", "path")


@query("loaded_members", with_("corpus") + f"""
, tl AS (SELECT DISTINCT CAST(pair_id % {len(MEMBER_WEIGHTS)} AS VARCHAR) AS model FROM corpus
         WHERE tl <> '' AND pair_id NOT IN (SELECT pair_id FROM corpus ORDER BY md5('{qv.SEED}:' || CAST(pair_id AS VARCHAR)), pair_id
                                            LIMIT {qv.N_VALID}))
SELECT d.model, tl.model IS NOT NULL AS available, CASE WHEN tl.model IS NULL THEN 'no path' END AS reason
FROM ({_MEMBERS_SQL}) d LEFT JOIN tl ON tl.model = d.model
""")
def loaded_members(spark, sf):
    """Every declared member's file is opened and verified on an executor."""
    return members.check_members(_member_files(spark, sf)).select("model", "available", "reason")


@query("ensemble_decode")
def ensemble_decode(spark, sf):
    """E1/E2/E4/X3 with members that see the source and the whole prefix:
    every source line of the prepared corpus is decoded over the whole
    vocabulary from ``<s>`` until ``</s>``, a repeated id or 512 ids, by the
    members whose files load."""
    model, _, enc = qv._encoded_corpus(spark, sf)
    ids = {t: i for i, t in enumerate(model.specials)}
    bos, eos, vocab = ids[T.BOS], ids[T.EOS], len(model.token_bytes)
    loaded = members.loaded_members(members.check_members(_member_files(spark, sf)))
    lines = enc.filter("side = 'sl'").select("split", "pair_id", T.truncate(F.col("ids"), T.MAX_LENGTH).alias("src"),
                                             F.array(F.lit(bos)).alias("prefix"))
    out = scorers.decode_sources(lines, lambda: members.table_members(loaded, bos, MEMBER_WEIGHTS), eos, vocab,
                                 keys=("split", "pair_id"), stop_on_repeat=True)
    return out.select("split", "pair_id", F.size("ids").cast("bigint").alias("n_ids"),
                      F.md5(F.array_join("ids", " ")).alias("ids_md5"), "stop")
