"""Preference data: chosen and rejected conversations as one prompt and two masked completions.

The longest common prefix of turns of both conversations is rendered once; what follows on each side is a completion,
of which only replies are trained on. All of it is DataFrame expressions on one row per pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.operators.ranking import dense_ranks
from ebbtide.session import stage

# Fixed values of the chat format.
START, END, REPLY = "<|im_start|>", "<|im_end|>", "assistant"


def _turns(rows: DataFrame, id_col: str, name: str) -> DataFrame:
    """One row per conversation with its turns in order; turns without a number come last, ties in order of text."""
    turn = F.struct(
        F.col("turn").isNull().alias("late"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = F.transform(F.sort_array(F.collect_list(turn)), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return rows.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("pair_id")).agg(turns.alias(name))


def _head(role: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"))


def _body(turn: Column) -> Column:
    return F.concat(turn["text"], F.lit(END + "\n"))


def _completion(turns: Column, opened: Column) -> Column:
    """Turns as pieces (head, body, trained); the first has no head where the prompt already holds it."""
    return F.transform(
        turns,
        lambda t, i: F.struct(
            F.when(opened & (i == 0), F.lit("")).otherwise(_head(t["role"])).alias("head"),
            _body(t).alias("body"),
            (t["role"] == REPLY).alias("trained"),
        ),
    )


def _text(pieces: Column) -> Column:
    return F.concat_ws("", F.transform(pieces, lambda p: F.concat(p["head"], p["body"])))


def _spans(pieces: Column) -> Column:
    """Trained places as start+length, comma-separated, in characters of the completion."""
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(held: Column, piece: Column) -> Column:
        start = held["at"] + F.char_length(piece["head"])
        span = F.concat(start.cast("string"), F.lit("+"), F.char_length(piece["body"]).cast("string"))
        spans = F.when(piece["trained"], F.array_append(held["spans"], span)).otherwise(held["spans"])
        return F.struct((start + F.char_length(piece["body"])).alias("at"), spans.alias("spans"))

    return F.aggregate(pieces, state, step, lambda held: F.concat_ws(",", held["spans"]))


def rendered_pairs(chosen: DataFrame, rejected: DataFrame, id_col: str = "pair_id") -> DataFrame:
    """(pair_id, n_prompt_turns, prompt, chosen, chosen_trained, rejected, rejected_trained) for each chosen
    conversation; both inputs have (pair_id, turn, role, text) with one row per turn.

    Turns are equal where role and text are; a null role or text is an empty one. Where both sides go on with a reply,
    its header belongs to the prompt. Equal conversations have empty completions; a chosen one without a rejected
    partner meets an empty one; a rejected one without a chosen partner and turns without a pair are left out.
    Repeated turns count as turns of their own. Other columns are ignored. ``*_trained`` lists the characters of a
    completion to train on: its replies and the marks that end them."""
    both = _turns(chosen, id_col, "a").join(_turns(rejected, id_col, "b"), "pair_id", "left")
    both = both.withColumn("b", F.coalesce("b", F.array().cast("array<struct<role: string, text: string>>")))
    shorter = F.least(F.size("a"), F.size("b"))
    places = F.when(shorter > 0, F.sequence(F.lit(0), shorter - 1)).otherwise(F.array().cast("array<int>"))
    apart = F.filter(places, lambda i: F.get("a", i) != F.get("b", i))
    split = both.withColumn("n_prompt_turns", F.coalesce(F.get(apart, F.lit(0)), shorter))
    rest = {side: F.slice(side, F.col("n_prompt_turns") + 1, F.greatest(F.size(side) - F.col("n_prompt_turns"), F.lit(0))) for side in "ab"}
    split = split.select("pair_id", "n_prompt_turns", F.slice("a", 1, F.col("n_prompt_turns")).alias("shared"), *[c.alias(s) for s, c in rest.items()])
    opened = (F.size("a") > 0) & (F.get("a", F.lit(0))["role"] == REPLY) & ((F.size("b") == 0) | (F.get("b", F.lit(0))["role"] == REPLY))
    split = split.withColumn("opened", F.coalesce(opened, F.lit(False)))
    pieces = split.select(
        "pair_id",
        "n_prompt_turns",
        F.concat(
            F.concat_ws("", F.transform("shared", lambda t: F.concat(_head(t["role"]), _body(t)))),
            F.when(F.col("opened"), _head(F.lit(REPLY))).otherwise(F.lit("")),
        ).alias("prompt"),
        _completion(F.col("a"), F.col("opened")).alias("a"),
        _completion(F.col("b"), F.col("opened")).alias("b"),
    )
    return pieces.select(
        "pair_id",
        "n_prompt_turns",
        "prompt",
        _text(F.col("a")).alias("chosen"),
        _spans(F.col("a")).alias("chosen_trained"),
        _text(F.col("b")).alias("rejected"),
        _spans(F.col("b")).alias("rejected_trained"),
    )


def preference_pairs(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected turns (pair_id, turn, role, text) made from plain conversations (conv_id, turn, role, text).

    Every conversation with a reply is chosen as it is. Its rejected side has the same turns before the last reply and
    then those of the conversation with a reply that comes next by id, whatever the gap, from that one's last reply on;
    nothing follows for the one of greatest id. A reply whose turn has no number does not count as one."""
    turns = conversations.select("conv_id", "turn", "role", "text")
    replied = turns.where((F.col("role") == REPLY) & F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    last = stage(replied.groupBy("conv_id").agg(F.max("turn").alias("last_reply")), "last-replies")
    ranks = stage(dense_ranks(last, "conv_id", "rank"), "conversation-ranks")
    before = ranks.select(F.col("conv_id").alias("pair_id"), (F.col("rank") + 1).alias("rank"))
    last = last.join(ranks.join(before, "rank", "left").select("conv_id", "pair_id"), "conv_id")
    turns = turns.join(last, "conv_id").withColumn("after", F.col("turn") >= F.col("last_reply"))
    chosen = turns.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    kept = turns.where(~F.col("after")).select(F.col("conv_id").alias("pair_id"), F.struct(F.lit(0).alias("part"), "turn").alias("turn"), "role", "text")
    other = turns.where("after").select("pair_id", F.struct(F.lit(1).alias("part"), "turn").alias("turn"), "role", "text")
    return chosen, kept.union(other)
