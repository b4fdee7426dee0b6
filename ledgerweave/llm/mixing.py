"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic. Raking scales the
cells' token weights to the target shares of one dimension after another until
all three marginals hold. A cell's ratio of raked to present tokens, divided by
a common scale, is the probability with which each of its documents is kept, so
the expected tokens of the sample have the target marginals. The scale is the
least power of 2^(1/16) above which cells of at most ``WHOLE`` of the raked
weight have their ratio: those few, rare cells are kept whole.

Whether a document is kept is decided by a hash of its id, not by chance: the
same id always falls alike. A null source or language is a value of its own. A
cell without tokens has probability 0. The table has no topic: a document's
topic is the hash class that most of its longer words fall into (-1 without
such words). Columns of the input named like a result are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.llm.common import batches_of, id_text, ship, vectorised, without, words
from ledgerweave.session import stage

ship(__name__)

DIMENSIONS = ("source", "lang", "topic")
TOPICS, LEAST_BYTES = 8, 5
#: Present shares are raised to this power and normalised: rare values gain, frequent ones lose.
TEMPER = 0.7
ROUNDS = 8
#: So much of the raked weight may be in cells that would need more tokens than they have.
WHOLE = 0.01


@vectorised("tokens long, topic int")
def _measured(texts):
    import hashlib

    import pandas as pd

    known: dict[bytes, int] = {}
    tokens, topics = [], []
    for t in texts:
        found = words(t)
        if len(known) > 200_000:  # what is kept for speed stays small
            known.clear()
        for w in set(found).difference(known):
            known[w] = int(hashlib.md5(w).hexdigest()[0], 16) % TOPICS if len(w) >= LEAST_BYTES else TOPICS
        counts = np.bincount(np.fromiter(map(known.__getitem__, found), np.int64, len(found)), minlength=TOPICS + 1)[:TOPICS]
        tokens.append(len(found))
        topics.append(int(counts.argmax()) if counts.any() else -1)
    return pd.DataFrame({"tokens": tokens, "topic": topics})


def tempered(cells: DataFrame, dimension: str, power: float = TEMPER) -> DataFrame:
    """Target shares of a dimension's values: their present shares tempered."""
    present = cells.groupBy(dimension).agg(F.sum("tokens").alias("present")).where("present > 0")
    total = present.agg(F.sum(F.pow("present", F.lit(power)))).first()[0] or 1.0
    return present.select(dimension, (F.pow("present", F.lit(power)) / total).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (the dimensions, tokens) with weight: tokens raked to the target shares of each
    dimension. ``targets``: for each dimension a table (dimension, share); values it leaves out get weight 0.

    Both the cells and the marginals may be large: each step is a partial aggregate and a join. Each is written,
    as its rows are read twice by the next one: plans that held several would double with each.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    raked = cells.withColumn("weight", F.col("tokens").cast("double"))
    targets = {d: stage(t, "mix-target") for d, t in targets.items()}
    for _ in range(rounds):
        for d, target in targets.items():
            margin = raked.groupBy(d).agg(F.sum("weight").alias("margin"))
            factor = margin.join(target, d, "left").select(
                d, F.when(F.col("margin") > 0, F.coalesce("share", F.lit(0.0)) * total / F.col("margin")).otherwise(0.0).alias("factor"))
            raked = stage(raked.join(factor, d).select(*cells.columns, (F.col("weight") * F.col("factor")).alias("weight")), "mix-step")
    return raked


def _values(docs: DataFrame) -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")).alias(c) for c in ("source", "lang")]


def _scale(ratios: DataFrame) -> float:
    """The least power of 2^(1/16) with at most WHOLE of the weight in larger ratios. The powers of
    all positive doubles are some thirty thousand: a small table whatever the number of cells."""
    power = F.ceil(F.round(F.log2("ratio") * 16, 6))
    by = ratios.where("ratio > 0").groupBy(power.alias("power")).agg(F.sum("weight").alias("weight")).orderBy(F.desc("power")).collect()
    above, total, least = 0.0, sum(w for _, w in by), 0
    for p, w in by:
        if above > WHOLE * total:
            break
        least, above = p, above + w
    return 2.0 ** (least / 16)


def mix(docs: DataFrame, power: float = TEMPER, rounds: int = ROUNDS, seed: str = "mix", keep_text: bool = True) -> DataFrame:
    """``docs`` with tokens, topic, mix_probability and mix_kept.

    Texts are read through once; without ``keep_text`` they are not in the written table and the result.
    """
    batches_of(docs.sparkSession)
    docs = without(docs, "tokens", "topic", "mix_probability", "mix_kept")
    columns = [c for c in docs.columns if keep_text or c != "text"]
    docs = stage(docs.select(*[F.col(f"`{c}`") for c in columns], _measured("text").alias("_mix_measured")), "mix-measured")
    measured = docs.select(*_values(docs), F.col("_mix_measured").alias("m")).select("source", "lang", "m.topic", "m.tokens")
    cells = stage(measured.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "mix-cells")
    raked = rake(cells, {d: tempered(cells, d, power) for d in DIMENSIONS}, rounds)
    ratio = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)
    scale = _scale(raked.select("weight", ratio.alias("ratio")))
    chance = stage(raked.select(*[F.col(d).alias(f"_mix_{d}") for d in DIMENSIONS], F.least(F.lit(1.0), ratio / scale).alias("mix_probability")), "mix-chances")
    keyed = docs.withColumns({f"_mix_{c.lower()}": v for c, v in zip(("source", "lang"), _values(docs), strict=True)})
    keyed = keyed.withColumn("_mix_topic", F.col("_mix_measured.topic"))
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), id_text())), 1, 13), 16, 10).cast("double") / float(16**13)
    return keyed.join(chance, [f"_mix_{d}" for d in DIMENSIONS]).select(
        *[F.col(f"`{c}`") for c in columns], F.col("_mix_measured.tokens").alias("tokens"), F.col("_mix_topic").alias("topic"),
        "mix_probability", (drawn < F.col("mix_probability")).alias("mix_kept"))


def oracle(power: float = TEMPER, rounds: int = ROUNDS, seed: str = "mix") -> str:
    """DuckDB's SQL for the rows of the query over ``mix``."""
    upper = "".join(map(chr, range(65, 91)))
    low = f"translate(coalesce(text, ''), '{upper}', '{upper.lower()}')"
    steps = [f"""
measured AS (SELECT coalesce(source, chr(0)) AS source, coalesce(lang, chr(0)) AS lang, doc_id, n,
  [w FOR w IN string_split_regex({low}, '[\\x20\\x09-\\x0d]+') IF w <> ''] AS found
  FROM (SELECT *, row_number() OVER () AS n FROM documents)),
classes AS (SELECT n, ('0x' || substr(md5(w), 1, 1))::INTEGER % {TOPICS} AS class, count(*) AS k
  FROM (SELECT n, unnest(found) AS w FROM measured) WHERE strlen(w) >= {LEAST_BYTES} GROUP BY ALL),
topics AS (SELECT n, arg_min(class, (-k, class)) AS topic FROM classes GROUP BY n),
docs AS (SELECT doc_id, source, lang, coalesce(topic, -1)::INTEGER AS topic, len(found)::BIGINT AS tokens FROM measured LEFT JOIN topics USING (n)),
cells AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM docs GROUP BY ALL)"""]
    for d in DIMENSIONS:
        steps.append(f"""target_{d} AS MATERIALIZED (SELECT {d}, pow(t, {power}) / sum(pow(t, {power})) OVER () AS share
  FROM (SELECT {d}, sum(tokens) AS t FROM cells GROUP BY {d}) WHERE t > 0)""")
    last = "SELECT source, lang, topic, tokens, tokens AS weight FROM cells"
    for i in range(rounds):
        for d in DIMENSIONS:
            steps.append(f"""r{i}_{d} AS MATERIALIZED (SELECT s.source, s.lang, s.topic, s.tokens,
  CASE WHEN s.margin > 0 THEN s.weight * coalesce(share, 0) * s.total / s.margin ELSE 0 END AS weight
  FROM (SELECT *, sum(weight) OVER (PARTITION BY {d}) AS margin, sum(tokens) OVER () AS total FROM ({last})) s LEFT JOIN target_{d} t ON s.{d} = t.{d})""")
            last = f"SELECT * FROM r{i}_{d}"
    steps.append(f"ratios AS (SELECT source, lang, topic, weight, CASE WHEN tokens > 0 THEN weight / tokens ELSE 0 END AS ratio FROM ({last}))")
    steps.append("powers AS (SELECT ceil(round(log2(ratio) * 16, 6)) AS power, sum(weight) AS w FROM ratios WHERE ratio > 0 GROUP BY 1)")
    steps.append(f"""scale AS (SELECT pow(2, coalesce(min(power), 0) / 16) AS scale FROM (
  SELECT power, sum(w) OVER (ORDER BY power DESC) - w AS above, sum(w) OVER () AS total FROM powers) WHERE above <= {WHOLE} * total)""")
    steps.append("chances AS (SELECT source, lang, topic, least(1.0, ratio / scale) AS p FROM ratios, scale)")
    return f"""WITH {', '.join(steps)}
SELECT doc_id, topic, tokens, round(p, 6) AS probability,
  ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::UBIGINT::DOUBLE / {float(16**13)} < p AS kept
FROM docs JOIN chances USING (source, lang, topic)"""
