"""Problem 9: records of several sources mixed to target shares of all tokens, with capped repeats."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.llm.tokens import TOKENIZER, with_token_counts
from voxloom.operators.scan import block_scan, salted_join
from voxloom.session import checkpointed

#: Hash ranges into which a leaf's documents are cut for the running sum of tokens.
BLOCKS = 512
#: Domains of sources, a parameter everywhere; sources not named here are the domain ``REST``.
DOMAINS = {"lecture_transcript": "speech", "qa_session": "speech"}
REST = "writing"


class Node:
    """A node of the budget tree: a leaf's ``room`` is its tokens times its repeats, an inner node's that of its children."""

    def __init__(self, name: str, weight: float, children: list[Node] | None = None, room: float = 0.0):
        self.name, self.weight, self.children = name, weight, children or []
        self.room = sum(c.room for c in self.children) if self.children else room
        self.budget = 0.0


def share_out(node: Node, budget: float) -> float:
    """Give ``budget`` to the subtree; return what it could not take.

    Children get it by weight; what a child can't take is dealt again among its siblings with room, by weight. Only what a
    whole family can't take goes back to the parent, which deals it among that family's siblings in turn.
    """
    budget_in = min(budget, node.room)
    node.budget = budget_in
    if node.children:
        for c in node.children:
            c.budget = 0.0
        give, open_ = budget_in, [c for c in node.children if c.room > 0 and c.weight > 0]
        while give > 1e-6 and open_:
            total = sum(c.weight for c in open_)
            capped = [c for c in open_ if c.room - c.budget <= give * c.weight / total + 1e-9]
            if not capped:
                for c in open_:
                    c.budget += give * c.weight / total
                give = 0.0
            else:
                for c in capped:
                    give -= c.room - c.budget
                    c.budget = c.room
                open_ = [c for c in open_ if c not in capped]
        for c in node.children:
            share_out(c, c.budget)
        node.budget = sum(c.budget for c in node.children)
    return budget - node.budget


def budgets(pdf: pd.DataFrame, total_tokens: float | None = None, total_share: float | None = None, domains: dict[str, str] = DOMAINS) -> pd.DataFrame:
    """Budget of every (doc_source, lang) leaf of one mix.

    The mix asks for ``total_tokens``, or ``total_share`` times what its sources hold; with neither it is as large as the caps allow with
    every source at its exact target. A domain weighs as much as its sources' targets, languages of a source as much as their tokens.
    Sources without documents get nothing; their share goes to their siblings.
    """
    families: dict[str, list[Node]] = {}
    sources = []
    for name, part in pdf.groupby("doc_source", sort=True):
        part = part.sort_values("lang")
        reps = float(part["max_repeats"].iloc[0])
        leaves = [Node(r.lang, float(r.tokens), room=float(r.tokens) * reps) for r in part.itertuples(index=False)]
        sources.append(Node(name, float(part["target_share"].iloc[0]), leaves))
        families.setdefault(domains.get(name, REST), []).append(sources[-1])
    root = Node("", 1.0, [Node(d, sum(s.weight for s in members), members) for d, members in sorted(families.items())])
    live = [s for s in sources if s.room > 0 and s.weight > 0]
    if total_tokens is None and total_share is not None:
        total_tokens = total_share * float(pdf["tokens"].sum())
    if total_tokens is None:
        weight = sum(s.weight for s in live)
        total_tokens = min((s.room * weight / s.weight for s in live), default=0.0)
    share_out(root, total_tokens)
    rows = [(pdf["mix_name"].iloc[0], s.name, c.name, c.budget) for s in sources for c in s.children]
    return pd.DataFrame(rows, columns=["mix_name", "doc_source", "lang", "budget"])


def sized_documents(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """``doc_id, doc_source, lang, n_tokens`` of the documents that mixes may take, each once."""
    return checkpointed(with_token_counts(docs.select("doc_id", "text", F.col("source").alias("doc_source"), F.coalesce("lang", F.lit("?")).alias("lang"))
                             .filter("doc_id is not null and source is not null"), path=tokenizer).filter("n_tokens > 0").dropDuplicates(["doc_id"]))


def plan(sized: DataFrame, targets: DataFrame, total_tokens: float | None = None, total_share: float | None = None, domains: dict[str, str] = DOMAINS) -> DataFrame:
    """``mix_name, doc_source, lang, target_share, max_repeats, tokens, budget``: the leaves of every mix."""
    wanted = (targets.filter("mix_name is not null and doc_source is not null and target_share > 0 and max_repeats >= 1")
              .groupBy("mix_name", "doc_source").agg(F.max_by(F.struct("target_share", "max_repeats"), F.struct("target_share", "max_repeats")).alias("t"))
              .select("mix_name", "doc_source", "t.target_share", "t.max_repeats"))
    leaves = wanted.join(sized.groupBy("doc_source", "lang").agg(F.sum("n_tokens").alias("tokens")), "doc_source")
    # One row a mix, source and language: the tree of a mix is small, whatever the number of documents.
    tree = leaves.groupBy("mix_name").applyInPandas(lambda pdf: budgets(pdf, total_tokens, total_share, domains), "mix_name string, doc_source string, lang string, budget double")
    return leaves.join(tree, ["mix_name", "doc_source", "lang"])


def mix(docs: DataFrame, targets: DataFrame, tokenizer: str = TOKENIZER, seed: int = 11, total_tokens: float | None = None, total_share: float | None = None,
        domains: dict[str, str] = DOMAINS) -> DataFrame:
    """``mix_name, doc_source, lang, doc_id, n_tokens, repeats``: the documents of every mix and how often each is taken.

    Weights go down the tree mix - domain - source - language (see :func:`share_out`); languages stand below sources, so that what one
    language lacks is made up inside its source and the source keeps its target. A leaf's budget is spent on whole epochs of
    all its documents and then on the prefix of one more epoch, in an order seeded by mix, source, language and number of the epoch; a
    document belongs to the prefix if its middle token does, so a leaf misses its budget by half a document at most.
    The running sum is cut into hash ranges, so a source with a third of all rows spreads over many tasks.

    Documents without source or tokens, and sources in no mix, stay out. A null lang is a language of its own. Null mix
    names, sources, shares or repeats, shares of 0 and repeats under 1 leave a target out; of repeated (mix, source) rows the
    largest share counts.
    """
    return taken(sized := sized_documents(docs, tokenizer), plan(sized, targets, total_tokens, total_share, domains), seed)


def taken(sized: DataFrame, planned: DataFrame, seed: int = 11) -> DataFrame:
    """The documents that spend the budgets of :func:`plan`; see :func:`mix`."""
    epochs = F.floor(F.col("budget") / F.col("tokens") + 1e-9)
    spent = planned.select("mix_name", "doc_source", "lang", epochs.alias("epochs"), F.greatest(F.col("budget") - epochs * F.col("tokens"), F.lit(0.0)).alias("need"))
    of_leaf = spent.groupBy("doc_source", "lang").agg(F.collect_list(F.struct("mix_name", "epochs", "need")).alias("mixes"))
    asked = (salted_join(sized, of_leaf, ["doc_source", "lang"], F.col("doc_id"), how="inner").withColumn("m", F.explode("mixes"))
             .select("m.*", "doc_source", "lang", "doc_id", "n_tokens"))
    place = F.xxhash64(F.lit(seed), "mix_name", "doc_source", "lang", "epochs", "doc_id")
    ordered = asked.withColumns({"_h": place, "_b": F.shiftrightunsigned(place, 64 - BLOCKS.bit_length() + 1)})
    run = block_scan(ordered, ["mix_name", "doc_source", "lang"], "_b", [F.col("_h"), F.col("doc_id")], sums={"upto": F.col("n_tokens")})
    middle = F.col("upto") - F.col("n_tokens") / 2
    return (run.withColumn("repeats", (F.col("epochs") + F.when(middle < F.col("need"), 1).otherwise(0)).cast("int")).filter("repeats > 0")
            .select("mix_name", "doc_source", "lang", "doc_id", "n_tokens", "repeats"))


def checked(docs: DataFrame, targets: DataFrame, total_share: float, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row a mix that asks for more than some sources have: how many of its promises are broken (0 each).

    ``over_repeats`` documents taken more than max_repeats times, ``over_room`` leaves above their room, ``off_budget`` leaves that miss their
    budget by more than half of their longest document; ``short`` tells whether some source has less than its target of the total, and
    ``siblings_first`` whether every source with room left has at least its part of its domain's budget, and every domain with
    room left its part of the mix, so that shortages are made up among siblings before other domains.
    """
    sized = sized_documents(docs, tokenizer)
    planned = checkpointed(plan(sized, targets, total_share=total_share).withColumn("domain", F.coalesce(*[F.when(F.col("doc_source") == s, F.lit(d)) for s, d in DOMAINS.items()], F.lit(REST))))
    rows = taken(sized, planned).join(planned.select("mix_name", "doc_source", "lang", "max_repeats"), ["mix_name", "doc_source", "lang"])
    got = rows.groupBy("mix_name", "doc_source", "lang").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("got"), F.count_if(F.col("repeats") > F.col("max_repeats")).alias("over_repeats"))
    longest = sized.groupBy("doc_source", "lang").agg(F.max("n_tokens").alias("longest"))
    room = F.col("tokens") * F.col("max_repeats")
    leaves = planned.join(got, ["mix_name", "doc_source", "lang"], "left").join(longest, ["doc_source", "lang"])
    share = leaves.groupBy("mix_name", "domain", "doc_source").agg(
        F.sum("budget").alias("budget"), F.sum(room).alias("room"), F.max("target_share").alias("target"), F.sum(F.coalesce("over_repeats", F.lit(0))).alias("over_repeats"),
        F.count_if(F.coalesce("got", F.lit(0)) > room + 1e-6).alias("over_room"), F.count_if(F.abs(F.coalesce("got", F.lit(0)) - F.col("budget")) > F.col("longest") / 2 + 1).alias("off_budget"), F.sum("tokens").alias("tokens"))
    w, d = Window.partitionBy("mix_name"), Window.partitionBy("mix_name", "domain")  # a few sources each
    total = F.lit(total_share) * F.sum("tokens").over(w)
    wished = share.withColumns({"wish": F.col("target") / F.sum("target").over(w) * total, "left": F.col("room") - F.col("budget")})
    inside = wished.withColumns({"d_wish": F.sum("wish").over(d), "d_left": F.sum("left").over(d), "d_budget": F.sum("budget").over(d)})
    # With room left a source has at least its part of the domain, and a domain its part of the mix: only full ones get less.
    even = (F.col("left") <= 1) | (F.col("budget") + 1 >= F.col("target") / F.sum("target").over(d) * F.col("d_budget"))
    whole = (F.col("d_left") <= 1) | (F.col("d_budget") + 1 >= F.col("d_wish"))
    return inside.withColumn("ok", even & whole).groupBy("mix_name").agg(
        F.count("*").alias("sources"), F.sum("over_repeats").cast("bigint").alias("over_repeats"), F.sum("over_room").cast("bigint").alias("over_room"), F.sum("off_budget").cast("bigint").alias("off_budget"),
        F.max(F.col("budget") < F.col("wish") - 1).alias("short"), F.min("ok").alias("siblings_first"))


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """``mix_name, doc_source, target_share, actual_share, tokens, documents, most_repeats`` of every target."""
    got = mixed.groupBy("mix_name", "doc_source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"), F.count("*").alias("documents"), F.max("repeats").alias("most_repeats"))
    total = got.groupBy("mix_name").agg(F.sum("tokens").alias("all_tokens"))
    return (targets.select("mix_name", "doc_source", "target_share").join(got, ["mix_name", "doc_source"], "left").join(total, "mix_name", "left")
            .select("mix_name", "doc_source", "target_share", F.round(F.coalesce(F.col("tokens") / F.col("all_tokens"), F.lit(0.0)), 6).alias("actual_share"),
                    F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats")))
