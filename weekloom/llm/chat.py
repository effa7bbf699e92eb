"""Chat formatting of reply trees.

Method: messages name their parent. Self-joins that double their reach (2, 4, 8, ... steps up) find every
message's distance to its root and the sum of scores on the way, so a tree of depth d takes log2(d) joins;
messages that have reached their root take no part in the next one.
Leaves are ranked by mean score, within their conversation or their tree; the chosen paths are expanded by the same tables and
each is formatted as one conversation.

Texts join only the chosen paths, once. A formatted conversation is one row, so one path must fit in a row.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekloom.llm.common import stored

#: Strings that chat templates use for control. Inside texts and roles they get a backslash after their first character, and backslashes are doubled.
CONTROL = ("<|", "|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<bos>", "<eos>", "<start_of_turn>", "<end_of_turn>")
START, HEAD, END = "<|im_start|>", "\n", "<|im_end|>\n"
_ESCAPE = re.compile("(?=" + "|".join(re.escape(c) for c in CONTROL) + ")(.)", re.DOTALL)
_TURN = re.compile(re.escape(START) + r"(.*?)" + HEAD + r"(.*?)" + re.escape(END), re.DOTALL)


def escape(text: str) -> str:
    """Reversible; the result holds no control string."""
    return _ESCAPE.sub(r"\1\\", text.replace("\\", "\\\\"))


def escape_role(role: str) -> str:
    """A role ends at the line break, so its own line breaks are written as ``\\n``."""
    return escape(role).replace("\n", "\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def unescape_role(role: str) -> str:
    return re.sub(r"\\(\\|n|)", lambda m: "\n" if m.group(1) == "n" else m.group(1), role)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation, and the spans of its text that count for the loss: the assistant's texts."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = START + escape_role(role) + HEAD, escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    return [(unescape_role(m.group(1)), unescape(m.group(2))) for m in _TURN.finditer(formatted)]


FORMATTED = T.StructType([T.StructField("formatted", T.StringType()), T.StructField("loss", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))])


@F.arrow_udf(FORMATTED)
def _format(turns: pa.Array) -> pa.Array:
    out = []
    for conv in turns.to_pylist():
        text, spans = format_turns([(t["role"], t["text"]) for t in conv])
        out.append({"formatted": text, "loss": [{"start": a, "end": b} for a, b in spans]})
    return pa.array(out, pa.struct([("formatted", pa.string()), ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]))


DIGESTS = T.StructType([T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
                        T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())])


@F.arrow_udf(DIGESTS)
def read_back(formatted: pa.Array, loss: pa.Array) -> pa.Array:
    """Digests of the turns and of the text under the loss mask, both parsed from the formatted conversation."""
    out = []
    for text, spans in zip(formatted.to_pylist(), loss.to_pylist()):
        turns = parse_turns(text)
        under = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
        out.append({"n_turns": len(turns), "turns_sha256": hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), "loss_chars": len(under),
                    "loss_sha256": hashlib.sha256(under.encode()).hexdigest(), "formatted_chars": len(text)})
    return pa.array(out, pa.struct([("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]))


def thread_of(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, node, parent, role, text, score) of flat conversations: each row replies to the one before it.

    Order: turn (null first), then role, then text, so that ties and repeated rows have their place. A
    conversation ends up in one row, hence the window over it is no larger than its result.
    """
    w = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    node = F.row_number().over(w).cast("long")
    return rows.withColumn("node", node).select("conv", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def chosen_paths(messages: DataFrame, branches: int | None = None, per_root: bool = False) -> DataFrame:
    """(conv, leaf, rank, depth, mean_score, node, place) for the ``branches`` best leaves of every conversation, or of every root in it; None: all leaves.

    ``messages`` holds (conv, node, parent, score), one row for each (conv, node). place counts from the
    leaf (0) up to the root.
    """
    base = messages.select("conv", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    known = base.select(F.col("conv").alias("pc"), F.col("node").alias("pn"))
    # steps and total count the messages from the node up to, but not including, ``up``; without ``up`` they are whole and ``root`` is known
    state = stored(base.join(known, _same(base["conv"], F.col("pc")) & (base["parent"] == F.col("pn")), "left")
                   .select("conv", "node", F.col("pn").alias("up"), F.when(F.col("pn").isNull(), F.col("node")).alias("root"), F.lit(1).cast("long").alias("steps"), F.col("score").alias("total")), "replies")
    done, live, levels = state.filter("up IS NULL"), state.filter("up IS NOT NULL"), []
    largest = base.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    for _ in range(int(largest).bit_length()):
        if live.isEmpty():
            break
        levels.append(live)                                      # ``up`` is 2^k steps above the node
        above = done.unionByName(live).select(F.col("conv").alias("ac"), F.col("node").alias("an"), F.col("up").alias("a_up"), F.col("root").alias("a_root"), F.col("steps").alias("a_steps"), F.col("total").alias("a_total"))
        state = stored(live.join(above, _same(live["conv"], F.col("ac")) & (live["up"] == F.col("an")))
                       .select("conv", "node", F.col("a_up").alias("up"), F.col("a_root").alias("root"), (F.col("steps") + F.col("a_steps")).alias("steps"), (F.col("total") + F.col("a_total")).alias("total")), "reach")
        done, live = done.unionByName(state.filter("up IS NULL")), state.filter("up IS NOT NULL")
    # nodes that are still live are on a cycle or below one and have no root
    leaves = done
    if levels:
        parents = levels[0].select(F.col("conv").alias("pc"), F.col("up").alias("pn")).distinct()
        leaves = done.join(parents, _same(done["conv"], F.col("pc")) & (done["node"] == F.col("pn")), "left_anti")
    scored = leaves.select("conv", "root", F.col("node").alias("leaf"), F.col("steps").alias("depth"), (F.col("total") / F.col("steps")).alias("mean_score"))
    rank = F.row_number().over(Window.partitionBy("conv", *["root"] * per_root).orderBy(F.desc("mean_score"), F.desc("depth"), "leaf"))
    ranked = scored.withColumn("rank", rank)
    best = stored((ranked if branches is None else ranked.filter(F.col("rank") <= branches)).drop("root"), "leaves")
    path = best.withColumn("node", F.col("leaf")).withColumn("place", F.lit(0).cast("long"))
    for k in reversed(range(len(levels))):
        up = levels[k].select(F.col("conv").alias("uc"), F.col("node").alias("un"), "up")
        higher = path.join(up, _same(path["conv"], F.col("uc")) & (path["node"] == F.col("un"))).select(
            "conv", "leaf", "depth", "mean_score", "rank", F.col("up").alias("node"), (F.col("place") + (1 << k)).alias("place"))
        path = stored(path.unionByName(higher), "paths")
    return path


def format_trees(messages: DataFrame, branches: int | None = None, per_root: bool = False) -> DataFrame:
    """(conv, leaf, rank, depth, mean_score, formatted, loss), one row for each chosen root-to-leaf path.

    ``messages`` holds conv, node, parent, role, text, score. Branches of a conversation rank by the mean
    score of their messages, then by depth, then by leaf; all are kept unless ``branches`` names a number for
    each conversation or, with ``per_root``, for each tree in it, which then ranks by itself.

    Defined results: null roles, texts count as empty, null scores as 0; a parent that is missing makes
    its reply a root; messages on a cycle, or below one, have no root and are in no path; of repeated
    (conv, node) the row with the smallest parent, role and text counts; a null conv is a conversation
    of its own; null nodes are left out, as no reply can name them; no messages give no rows.
    """
    one = messages.filter("node IS NOT NULL").groupBy("conv", "node").agg(F.min(F.struct("parent", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "score")).alias("m"))
    nodes = stored(one.select("conv", "node", "m.*"), "messages")
    path = chosen_paths(nodes, branches, per_root)
    said = nodes.select(F.col("conv").alias("nc"), F.col("node").alias("nn"), "role", "text")
    turns = path.join(said, _same(path["conv"], F.col("nc")) & (path["node"] == F.col("nn")))
    whole = turns.groupBy("conv", "leaf", "rank", "depth", "mean_score").agg(F.sort_array(F.collect_list(F.struct((-F.col("place")).alias("at"), "role", "text"))).alias("turns"))
    done = whole.select("conv", "leaf", "rank", "depth", "mean_score", _format("turns").alias("f"))
    return done.select("conv", "leaf", "rank", "depth", "mean_score", "f.formatted", "f.loss")
