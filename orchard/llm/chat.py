"""Transcript parsing: a hidden Markov model recovers speakers, then turns are rendered.

A transcript is plain text in which some turns open with a speaker marker in one of
many styles and some with none.  Each line has a hidden state, the speaker and
whether the line opens a turn, and emits features: the marker's kind, what stands
before the line, its length, its last and its first character.  Start, transition
and emission probabilities are smoothed relative frequencies from transcripts whose
turns are known; their counts are combined in Spark and bounded by states times
feature values.  Viterbi decoding gives the most likely states of a transcript;
turns are cut where a line opens one and rendered canonically.

Transcripts are made from turn tables (``transcripts``), at most ``PART`` turn
numbers to one, so that a very long conversation is several transcripts; the later
ones start in any state.

Defined results: null texts are empty; an empty transcript is one turn of no text
(the likeliest first speaker); a null or unknown role writes no marker and is left
out of training; turns of equal number are ordered by role and text, repeated rows
stay; null ids form one conversation; an empty table gives no rows; with nothing
to train on all probabilities are equal; extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orchard.llm.common import table, tidy

# Speaker markers by kind, and the styles that ``transcripts`` writes.
ROLES = ("system", "user", "assistant")
MARKERS = {
    "system": ("System", "Instructions", "Context", "Setup"),
    "user": ("User", "Human", "Customer", "Q", "Me"),
    "assistant": ("Assistant", "AI", "Bot", "Agent", "A"),
}
STYLES = (
    ("System: ", "User: ", "Assistant: "),
    ("Instructions: ", "Human: ", "AI: "),
    ("### System\n", "### User\n", "### Assistant\n"),
    ("[Setup] ", "[Customer] ", "[Agent] "),
    ("<system> ", "<user> ", "<assistant> "),
    ("**Context:** ", "**Q:** ", "**A:** "),
)
PART = 256
UNMARKED = 6            # one in so many turns is written without a marker
_KIND = {w.lower(): 1 + ROLES.index(r) for r, ws in MARKERS.items() for w in ws}
_WORDS = "|".join(sorted(_KIND, key=len, reverse=True))
_MARKER = re.compile(rf"^(?:({_WORDS}):|#+ ?({_WORDS})\s*$|\[({_WORDS})\]|<({_WORDS})>|\*\*({_WORDS}):\*\*)\s*",
                     re.IGNORECASE)
_SIZES = (4, 3, 5, 4, 4)    # values of each feature
STATES = 2 * len(ROLES)     # 2 * role + (0 opens a turn, 1 goes on)


def marker(line: str) -> tuple[int, int]:
    """Kind (0: none, else 1 + role) and length of the speaker marker a line starts with."""
    m = _MARKER.match(line)
    return (_KIND[next(g for g in m.groups() if g).lower()], m.end()) if m else (0, 0)


def line_features(lines: list[str]) -> np.ndarray:
    """One row of feature values per line."""
    out = np.zeros((len(lines), len(_SIZES)), np.int64)
    before = 0                                  # 0 start, 1 blank line, 2 text
    for i, line in enumerate(lines):
        kind, at = marker(line)
        body = line[at:].strip()
        n = len(body)
        size = 0 if not line.strip() else 1 + (n >= 40) + (n >= 120) + (n >= 300)
        last = 0 if not body else 1 if body[-1] == "?" else 2 if body[-1] == ":" else 3
        first = 0 if not body else 1 if body[0].isupper() else 2 if body[0].islower() else 3
        out[i] = kind, before, size, last, first
        before = 1 if not line.strip() else 2
    return out


def transcripts(turns: DataFrame) -> DataFrame:
    """``conv_id, part, text, turns``: the transcript of each conversation and, for training
    and checks, its true turns (role, number of lines).  Style and gaps follow from hashes."""
    role = F.lower(F.col("role").cast("string"))
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES))).cast("int")
    marks = F.array(*[F.create_map(*[F.lit(x) for pair in zip(ROLES, s) for x in pair]) for s in STYLES])
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        role.alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("body"))
    bare = F.pmod(F.xxhash64("conv_id", "turn", "body"), F.lit(UNMARKED)) == 0
    mark = F.when(bare, "").otherwise(F.coalesce(F.try_element_at(marks[style], F.coalesce("role", F.lit(""))), F.lit("")))
    rows = rows.select("conv_id", F.floor(F.coalesce("turn", F.lit(0)) / PART).alias("part"), "turn", "role",
                       F.concat(mark, "body").alias("said"))
    listed = rows.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "said"))).alias("t"))
    return listed.select(
        "conv_id", "part", F.array_join(F.col("t.said"), "\n\n").alias("text"),
        F.transform("t", lambda x: F.struct(x["role"].alias("role"), F.size(F.split(x["said"], "\n", -1)).alias("lines"))).alias("turns"))


class TranscriptModel:
    """Log-probabilities of the model; a few hundred numbers."""

    def __init__(self, counts: pd.DataFrame):
        def table_of(kind: int, rows: int, cols: int) -> np.ndarray:
            n = np.full((rows, cols), 0.1)
            c = counts[counts["kind"] == kind]
            n[c["i"].to_numpy(int), c["j"].to_numpy(int)] += c["n"].to_numpy(float)
            return np.log(n / n.sum(axis=1, keepdims=True))

        self.start = table_of(-2, 1, STATES)[0]
        self.move = table_of(-1, STATES, STATES)
        self.emit = [table_of(f, STATES, size) for f, size in enumerate(_SIZES)]

    def decode(self, features: np.ndarray, first: bool = True) -> np.ndarray:
        """Most likely states (Viterbi); the first line opens a turn."""
        score = sum(e[:, features[:, f]] for f, e in enumerate(self.emit)).T
        best = score[0] + (self.start if first else 0.0)
        best[1::2] = -np.inf
        back = np.zeros((len(features), STATES), np.int8)
        for i in range(1, len(features)):
            each = best[:, None] + self.move
            back[i] = each.argmax(axis=0)
            best = each.max(axis=0) + score[i]
        path = np.empty(len(features), np.int64)
        path[-1] = best.argmax()
        for i in range(len(features) - 1, 0, -1):
            path[i - 1] = back[i, path[i]]
        return path

    def turns(self, text: str, first: bool = True) -> list[tuple[str, str]]:
        """(role, text) of each turn of a transcript."""
        lines = text.split("\n")
        path = self.decode(line_features(lines), first)
        out: list[tuple[str, list[str]]] = []
        for line, state in zip(lines, path):
            if state % 2 == 0:
                out.append((ROLES[state // 2], [line[marker(line)[1]:]]))
            else:
                out[-1][1].append(line)
        return [(role, "\n".join(ls).strip("\n")) for role, ls in out]


def fit(known: DataFrame) -> TranscriptModel:
    """Count states and features of ``known`` transcripts (``part, text, turns``)."""
    def run(it):
        for pdf in it:
            tally = [np.zeros((1, STATES)), np.zeros((STATES, STATES)), *(np.zeros((STATES, s)) for s in _SIZES)]
            for part, text, turns in zip(pdf["part"], pdf["text"], pdf["turns"]):
                state = []
                for t in turns:
                    s = 2 * ROLES.index(t["role"]) if t["role"] in ROLES else -9
                    state += [s] + [s + 1] * int(t["lines"])    # its lines and the blank one behind
                state = np.array(state[:-1])
                if len(state) == 0:
                    continue
                f = line_features(text.split("\n"))
                ok = state >= 0
                if part == 0 and ok[0]:
                    tally[0][0, state[0]] += 1
                both = ok[1:] & ok[:-1]
                np.add.at(tally[1], (state[:-1][both], state[1:][both]), 1)
                for k in range(len(_SIZES)):
                    np.add.at(tally[2 + k], (state[ok], f[ok, k]), 1)
            rows = [(k - 2, i, j, int(n[i, j])) for k, n in enumerate(tally) for i, j in zip(*np.nonzero(n))]
            yield pd.DataFrame(rows, columns=["kind", "i", "j", "n"])

    counts = (known.select("part", "text", "turns").mapInPandas(tidy(run), "kind int, i int, j int, n long")
              .groupBy("kind", "i", "j").agg(F.sum("n").alias("n")))
    return TranscriptModel(counts.toPandas())


def parse(transcript: DataFrame, model: TranscriptModel) -> DataFrame:
    """``conv_id, part, turns`` (array of role, text) of ``transcript(conv_id, part, text)``."""
    def run(it):
        for pdf in it:
            out = [[{"role": r, "text": t} for r, t in model.turns(text, part == 0)]
                   for part, text in zip(pdf["part"], pdf["text"])]
            yield pd.DataFrame({"conv_id": pdf["conv_id"], "part": pdf["part"], "turns": out})

    return transcript.select("conv_id", "part", F.coalesce("text", F.lit("")).alias("text")).mapInPandas(
        tidy(run), "conv_id long, part long, turns array<struct<role:string,text:string>>")


def render(parsed: DataFrame) -> DataFrame:
    """``conv_id, part, n_turns, rendered``: turns as <|role|>, text and <|end|>, line by line."""
    said = F.transform("turns", lambda t: F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["text"], F.lit("\n<|end|>")))
    return parsed.select("conv_id", "part", F.size("turns").alias("n_turns"), F.array_join(said, "\n").alias("rendered"))


def train_fold(conv_id: str = "conv_id") -> F.Column:
    """Three quarters of the conversations; the others are held out."""
    return F.pmod(F.crc32(F.coalesce(F.col(conv_id).cast("string"), F.lit("")).cast("binary")), F.lit(4)) != 2


def op3_chat_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = transcripts(table(spark, sf_dir, "conversations"))
    model = fit(raw.where(train_fold()))
    parsed = parse(raw, model)
    return render(parsed).withColumn("held_out", ~train_fold())


QUERIES = {"op3_chat_hmm": op3_chat_hmm}
