"""Problem 8: items into fixed-capacity containers by vector best-fit."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.tokens import TOKENIZER, with_token_counts
from voxloom.session import checkpointed

#: Items that one task packs. Waste is about one half-filled container a task, so shards are large but bounded.
SHARD_ITEMS = 20_000


def best_fit(sizes: np.ndarray, capacity: int, max_items: int, max_cost: float, rule: str = "norm", weights: tuple[float, float, float] = (1.0, 1.0, 1.0)) -> np.ndarray:
    """Container number of each item (sizes at most ``capacity``), largest items first.

    Every container has three residuals: tokens, items and attention cost (squares of item lengths). An item goes to an
    open container where it fits in all three: the one with the least norm of the residuals left after it (``norm``), or with
    the largest dot product of the item and what is taken (``dot``), both scaled by the capacities and weighted by ``weights``. Full
    containers are closed. An item whose cost alone is over the limit opens a container that then takes no other.
    """
    n = len(sizes)
    order = np.argsort(-sizes, kind="stable")
    cap = np.array([capacity, max_items, max_cost], dtype=float)
    left = np.empty((3, max(16, n)), dtype=float)
    names = np.empty(max(16, n), dtype=np.int64)
    weigh = np.array(weights, dtype=float)[:, None]
    used, made = 0, 0
    out = np.empty(n, dtype=np.int64)
    smallest = int(sizes.min()) if n else 0
    for i in order:
        s = int(sizes[i])
        need = np.array([s, 1.0, float(s) * s])
        at = -1
        if used:
            fits = np.flatnonzero((left[0, :used] >= need[0]) & (left[1, :used] >= 1) & (left[2, :used] >= need[2]))
            if len(fits):
                rest = left[:, fits] / cap[:, None]
                if rule == "norm":
                    score = -(weigh * np.square(rest - (need / cap)[:, None])).sum(axis=0)
                else:
                    # Tight containers first: the item's weight against what is taken, so the least room left wins.
                    score = (weigh * (need / cap)[:, None] * (1.0 - rest)).sum(axis=0)
                at = int(fits[int(np.argmax(score))])
        if at < 0:
            at = used
            left[:, at], names[at] = cap, made
            used, made = used + 1, made + 1
        left[:, at] -= need
        out[i] = names[at]
        if left[0, at] < smallest or left[1, at] < 1 or left[2, at] < smallest * smallest:
            used -= 1
            left[:, at], names[at] = left[:, used], names[used]
    return out


def pack(docs: DataFrame, plans: DataFrame, tokenizer: str = TOKENIZER, max_items: int = 4096, cost_share: float = 1.0, rule: str = "norm",
         weights: tuple[float, float, float] = (1.0, 1.0, 1.0), shard_items: int = SHARD_ITEMS) -> DataFrame:
    """``plan_name, container, doc_id, part, token_from, n_tokens, split``: where every document goes under every plan.

    A document that fits a container is never split. A larger one is cut into full containers of its own (``part`` 0, 1,
    ...) and a rest that is packed like a document. ``max_items`` documents at most share a container, and the squares of
    their lengths sum to ``cost_share`` x capacity squared at most; a single document may exceed that and is then alone.

    Items are dealt to shards at random, about ``shard_items`` each by a count of all items, and every shard is packed by
    itself, so no task holds more, however large a plan's share. Null and empty texts have no tokens and take no room; null
    ids, null plans and plans without a positive capacity are left out; repeated doc_ids count once. The text is read once
    for all plans.
    """
    sized = checkpointed(with_token_counts(docs.select("doc_id", "text").filter("doc_id is not null"), path=tokenizer).filter("n_tokens > 0").dropDuplicates(["doc_id"]))
    usable = plans.select("plan_name", F.col("capacity_tokens").cast("bigint").alias("cap")).filter("plan_name is not null and cap > 0").dropDuplicates(["plan_name"])
    # Plans are a parameter table of a few rows; each document meets each plan by definition of the result.
    listed = usable.agg(F.collect_list(F.struct("plan_name", "cap")).alias("plans"))
    each = sized.join(F.broadcast(listed)).select("doc_id", "n_tokens", F.explode("plans").alias("p")).select("doc_id", "n_tokens", "p.plan_name", "p.cap")
    whole = F.floor(F.col("n_tokens") / F.col("cap"))
    full = F.when(F.col("n_tokens") > F.col("cap"), whole).otherwise(F.lit(0))
    cut = each.withColumns({"full": full, "rest": F.col("n_tokens") - full * F.col("cap")})
    alone = (cut.filter("full > 0").withColumn("part", F.explode(F.sequence(F.lit(0), (F.col("full") - 1).cast("int"))))
             .select("plan_name", F.concat_ws("-", F.lit("f"), "doc_id", "part").alias("container"), "doc_id", "part", (F.col("part") * F.col("cap")).alias("token_from"),
                     F.col("cap").alias("n_tokens"), F.lit(True).alias("split")))
    shards = max(1, math.ceil(sized.count() / shard_items))
    rest = cut.filter("rest > 0").select("plan_name", "cap", "doc_id", "full", "rest", F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(shards)).alias("shard"))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id")
        cap, sizes = int(pdf["cap"].iloc[0]), pdf["rest"].to_numpy(dtype=np.int64)
        got = best_fit(sizes, cap, max_items, cost_share * cap * cap, rule, weights)
        shard = pdf["shard"].iloc[0]
        return pd.DataFrame({"plan_name": pdf["plan_name"], "container": [f"s-{shard}-{g}" for g in got], "doc_id": pdf["doc_id"], "part": pdf["full"].astype("int32"),
                             "token_from": pdf["full"] * cap, "n_tokens": sizes, "split": pdf["full"] > 0})

    packed = rest.groupBy("plan_name", "shard").applyInPandas(one, "plan_name string, container string, doc_id bigint, part int, token_from bigint, n_tokens bigint, split boolean")
    return alone.unionByName(packed)


def fill(packed: DataFrame, plans: DataFrame) -> DataFrame:
    """``plan_name, containers, items, tokens, fill``: the share of all containers' room that holds tokens."""
    return (packed.groupBy("plan_name", "container").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("i")).groupBy("plan_name")
            .agg(F.count("*").alias("containers"), F.sum("i").alias("items"), F.sum("t").alias("tokens"))
            .join(plans.select("plan_name", "capacity_tokens").filter("capacity_tokens > 0").dropDuplicates(["plan_name"]), "plan_name")
            .select("plan_name", "containers", "items", "tokens", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 6).alias("fill")))


def oversize(packed: DataFrame, plans: DataFrame) -> DataFrame:
    """``doc_id`` of documents that were split under the plan of the largest capacity."""
    largest = plans.filter("plan_name is not null and capacity_tokens > 0").agg(F.max_by("plan_name", F.struct("capacity_tokens", "plan_name")).alias("plan_name"))
    return packed.filter("split").join(F.broadcast(largest), "plan_name").select("doc_id").distinct()


def checked(docs: DataFrame, packed: DataFrame, plans: DataFrame, max_items: int, cost_share: float, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row a plan: how many containers or documents break a limit (0 each), and whether the limits were felt.

    ``over_tokens``, ``over_items`` and ``over_cost`` count containers beyond a limit (one document alone may cost more), ``torn`` documents
    that fit and were split, ``lost`` documents whose parts don't sum to their tokens. ``felt`` tells whether some container with room for
    more tokens is at the limit of documents or cost.
    """
    caps = plans.select("plan_name", F.col("capacity_tokens").cast("bigint").alias("cap")).filter("plan_name is not null and cap > 0").dropDuplicates(["plan_name"])
    sized = with_token_counts(docs.select("doc_id", "text").filter("doc_id is not null"), path=tokenizer).dropDuplicates(["doc_id"])
    rows = checkpointed(packed)
    boxes = rows.groupBy("plan_name", "container").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("i"), F.sum(F.col("n_tokens") * F.col("n_tokens")).alias("c")).join(caps, "plan_name")
    room, limit = F.col("cap") - F.col("t"), cost_share * F.col("cap") * F.col("cap")
    by_box = boxes.groupBy("plan_name").agg(
        F.count_if(F.col("t") > F.col("cap")).alias("over_tokens"), F.count_if(F.col("i") > max_items).alias("over_items"), F.count_if((F.col("c") > limit) & (F.col("i") > 1)).alias("over_cost"),
        F.max((F.col("i") == max_items) & (room > F.col("cap") / 10)).alias("items_felt"), F.max((F.col("c") > 0.9 * limit) & (room > F.col("cap") / 10)).alias("cost_felt"))
    per = rows.groupBy("plan_name", "doc_id").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("parts")).join(sized, "doc_id").join(caps, "plan_name")
    by_doc = per.groupBy("plan_name").agg(F.count("*").alias("documents"), F.count_if((F.col("parts") > 1) & (F.col("n_tokens") <= F.col("cap"))).alias("torn"), F.count_if(F.col("t") != F.col("n_tokens")).alias("lost"))
    return by_doc.join(by_box, "plan_name").select("plan_name", "documents", "torn", "lost", "over_tokens", "over_items", "over_cost", (F.col("items_felt") | F.col("cost_felt")).alias("felt"))
