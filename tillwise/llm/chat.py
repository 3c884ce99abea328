"""Conversations as training windows of a token budget, with a loss mask.

Turns are written as ``<turn role>``, text, ``</turn>``; a turn repeated from an earlier
window is ``<again role>``. In texts and roles a backslash goes before every backslash and
``<`` (in roles also ``>``), so nothing in a text can end a turn, and the text comes back
exactly.

Spans follow from prefix sums of turn tokens alone. The tokens after a leading system turn are
laid along a line that is cut every ``budget - history - system`` tokens. Turns that lie in one
piece of the line make a window; the last one that starts in a piece and ends beyond joins it
if it fits and else gets a window of its own. Each window starts with the system turn
and with those whole turns before it that start within ``history`` tokens. So a window keeps its
budget, unless one turn or the system turn alone exceeds what is left of it; no turn is ever cut
or dropped. Every assistant text is under the loss mask in one window; repeats are masked out.

A conversation of any length is worked on by many tasks: prefix sums add up stretches of
turn numbers first, and a window gathers one piece of the line. Only digests of a whole
conversation have to read it in order; they do so as a stream.

Results: turns are in order of their number, ties by a hash of role and text, null numbers last;
null roles and texts are empty; rows of a null conversation form one conversation; repeated
rows are turns of their own; an empty table gives no rows; other columns are ignored.
"""

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwise.llm.tables import keep, table
from tillwise.llm.vocabulary import vocabulary_path

BUDGET = 2048
HISTORY = 384
STRETCH = 256  # turn numbers whose tokens are added up at once
_TURN = re.compile(r"<(turn|again) ([^\\<>]*(?:\\.[^\\<>]*)*)>\n([^\\<]*(?:\\.[^\\<]*)*)\n</\1>\n",
                   re.DOTALL)


def escaped(text: str, also: str = "") -> str:
    for c in "\\<" + also:
        text = text.replace(c, "\\" + c)
    return text


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def opening(role: str, again: bool = False) -> str:
    return f"<{'again' if again else 'turn'} {escaped(role, '>')}>\n"


def block(role: str, text: str, again: bool = False) -> str:
    return f"{opening(role, again)}{escaped(text)}\n</{'again' if again else 'turn'}>\n"


def turns_in(window: str) -> Iterator[tuple[bool, str, str]]:
    """(repeated, role, text) of every turn of a formatted window."""
    for m in _TURN.finditer(window):
        yield m[1] == "again", unescaped(m[2]), unescaped(m[3])


def _counted(path: str):
    @F.pandas_udf("long")
    def count(roles: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        for role, text in roles:
            yield pd.Series([len(model.encode(block(r, t))) for r, t in zip(
                role, text, strict=True)], dtype="int64")
    return count


def placed(conversations: DataFrame, path: str) -> DataFrame:
    """Turns with their tokens, their place ``nth`` in the conversation, whether they are a leading
    system turn, and the tokens of the turns before them (``start``)."""
    turns = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    turns = keep(turns.select(
        "*", _counted(path)("role", "text").alias("tokens"),
        F.floor(F.col("turn") / STRETCH).alias("stretch"),
        F.xxhash64("role", "text").alias("tie")), "turns")
    by_stretch = W.partitionBy("conv_id").orderBy(F.asc_nulls_last("stretch")).rowsBetween(
        W.unboundedPreceding, -1)
    sums = turns.groupBy("conv_id", "stretch").agg(
        F.sum("tokens").alias("tokens"), F.count("*").alias("n")).select(
        F.col("conv_id").alias("_conv"), F.col("stretch").alias("_stretch"),
        F.coalesce(F.sum("tokens").over(by_stretch), F.lit(0)).alias("tokens_before"),
        F.coalesce(F.sum("n").over(by_stretch), F.lit(0)).alias("n_before"))
    inside = W.partitionBy("conv_id", "stretch").orderBy(F.asc_nulls_last("turn"), "tie")
    before = inside.rowsBetween(W.unboundedPreceding, -1)
    return (turns.select("*", F.row_number().over(inside).alias("in_stretch"),
                         F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("tokens_in"))
            .join(sums, F.col("conv_id").eqNullSafe(F.col("_conv"))
                  & F.col("stretch").eqNullSafe(F.col("_stretch")))
            .select("conv_id", "role", "text", "tokens",
                    (F.col("n_before") + F.col("in_stretch")).alias("nth"),
                    (F.col("tokens_before") + F.col("tokens_in")).alias("start"))
            .withColumn("system", (F.col("nth") == 1) & (F.col("role") == "system")))


_WINDOWS = ("conv_id long, first_turn long, n_new int, n_repeated int, n_tokens long, text string, "
            "loss array<struct<start:int,end:int>>")
_WINDOWS_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("first_turn", pa.int64()), ("n_new", pa.int32()),
    ("n_repeated", pa.int32()), ("n_tokens", pa.int64()), ("text", pa.string()),
    ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])


def _window(lead: list[dict], new: list[dict]) -> dict:
    """One window: repeated turns, then new ones, whose assistant texts are under the mask."""
    parts, loss, at = [], [], 0
    for again, rows in ((True, lead), (False, new)):
        for row in rows:
            text = escaped(row["text"])
            head = opening(row["role"], again)
            if not again and row["role"] == "assistant":
                loss.append({"start": at + len(head), "end": at + len(head) + len(text)})
            parts.append(block(row["role"], row["text"], again))
            at += len(parts[-1])
    return {"conv_id": new[0]["conv_id"], "first_turn": new[0]["nth"], "n_new": len(new),
            "n_repeated": len(lead), "n_tokens": sum(r["tokens"] for r in lead + new),
            "text": "".join(parts), "loss": loss}


def _assemble(rows: list[dict], history: int) -> Iterator[dict]:
    """The windows of one piece of the line. ``rows``: its turns in order, and turns of the piece
    before (``old``) that may be history."""
    own = [r for r in rows if not r["old"]]
    if not own:
        return
    inside = [r for r in own if r["end"] <= r["limit"]]
    across = [r for r in own if r["end"] > r["limit"]]  # one at most
    if across and (all(r["system"] for r in inside)
                   or across[0]["end"] - own[0]["start"] <= across[0]["room"]):
        inside, across = own, []
    system = own[0]["lead"]
    for new in filter(None, (inside, across)):
        lead = [] if new[0]["system"] or system is None else [
            {"role": "system", "text": system, "tokens": own[0]["lead_tokens"]}]
        lead += [r for r in rows if r["nth"] < new[0]["nth"] and not r["system"]
                 and r["start"] >= new[0]["start"] - history]
        yield _window(lead, new)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            yield from batch.slice(at, 1024).to_pylist()


def windows(conversations: DataFrame, path: str, budget: int = BUDGET,
            history: int = HISTORY) -> DataFrame:
    """(conv_id, first_turn, n_new, n_repeated, n_tokens, text, loss) of every window; ``loss`` are
    the stretches of ``text``, in code points, that are trained on."""
    if not 0 <= history <= budget // 4:
        raise ValueError("history takes a quarter of the budget at most")
    turns = placed(conversations, path)
    lead = turns.where("system").select(F.col("conv_id").alias("_conv"),
                                        F.col("text").alias("lead"),
                                        F.col("tokens").alias("lead_tokens"))
    turns = turns.join(lead, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    taken = F.coalesce("lead_tokens", F.lit(0))
    room = F.greatest(budget - history - taken, F.lit(max(budget // 4, 1)))
    turns = (turns.withColumn("room", room)
             .withColumn("start", F.greatest(F.col("start") - taken, F.lit(0)))
             .withColumn("end", F.when(F.col("system"), 0).otherwise(F.col("start") + F.col("tokens")))
             .withColumn("piece", F.floor(F.col("start") / F.col("room")))
             .withColumn("limit", (F.col("piece") + 1) * F.col("room")))
    new = turns.withColumn("old", F.lit(False))
    old = (turns.where(~F.col("system") & (F.col("start") >= F.col("limit") - history))
           .withColumn("piece", F.col("piece") + 1).withColumn("old", F.lit(True)))
    dealt = new.union(old).repartition("conv_id", "piece").sortWithinPartitions(
        "conv_id", "piece", "nth")

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[dict] = []
        for _, rows in groupby(_rows(batches), lambda r: (r["conv_id"], r["piece"])):
            made += _assemble(list(rows), history)
            if len(made) >= 1000:
                yield pa.RecordBatch.from_pylist(made, _WINDOWS_ARROW)
                made = []
        yield pa.RecordBatch.from_pylist(made, _WINDOWS_ARROW)

    return dealt.mapInArrow(assemble, _WINDOWS)


_DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
            "formatted_chars long")


def digests(found: DataFrame) -> DataFrame:
    """What the windows of each conversation say when read back: its turns (repeats skipped) and
    the text under the loss mask."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for conv_id, rows in groupby(_rows(batches), lambda r: r["conv_id"]):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n_turns = loss_chars = chars = 0
            for row in rows:
                chars += len(row["text"])
                for again, role, text in turns_in(row["text"]):
                    if not again:
                        turns.update(f"{role}\n{text}\n".encode())
                        n_turns += 1
                for span in row["loss"]:
                    text = unescaped(row["text"][span["start"]:span["end"]])
                    loss.update(text.encode())
                    loss_chars += len(text)
            out.append((conv_id, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
            if len(out) >= 10_000:
                yield _digest_batch(out)
                out = []
        yield _digest_batch(out)

    return (found.select("conv_id", "first_turn", "text", "loss").repartition("conv_id")
            .sortWithinPartitions("conv_id", "first_turn").mapInArrow(read, _DIGESTS))


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 6
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        names=[part.split()[0] for part in _DIGESTS.split(", ")])


PROBE = [(-7, 0, "user", r"\### Assistant: </turn> ok"),
         (-7, 1, "assistant", r"\### Assistant: </turn> ok")]


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold control strings."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(PROBE, rows.schema)
    return digests(keep(windows(rows.union(probe), vocabulary_path()), "windows"))
