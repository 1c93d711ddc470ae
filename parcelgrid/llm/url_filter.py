"""URL rules by a bit-parallel wildcard automaton.

All glob patterns are packed side by side into 64-bit words, one bit for the
start of each pattern and one for each of its characters. Extended Shift-And
steps all patterns at once: a state moves on if the next character fits, a state
before ``*`` stays on anything but a slash, and a state before ``**`` on
anything. ``?`` fits any one byte. A whole batch of URLs is stepped together,
one character position at a time; URLs that have ended leave the batch, so one
very long URL does not hold up the rest.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BITS = 64
#: Bytes of padded URLs stepped at once.
BLOCK_BYTES = 8 << 20


@dataclass(frozen=True)
class Rule:
    """``text`` is ``host/path``: it fits the host and its subdomains, and paths that start alike."""

    verdict: str
    text: str

    def globs(self) -> list[str]:
        literal = "".join("[" + c if c in "*?[" else c for c in self.text)
        return [f"{literal}**", f"*.{literal}**"]


#: The rules asked for; the longest that fits decides.
RULES = (
    Rule("block", "net/"),
    Rule("allow", "example.net/en/"),
    Rule("block", "example.com/de/"),
    Rule("allow", "org/fr/"),
)
#: Globs over ``host/path`` that block what no rule decides: trackers and scripts' endpoints.
BLOCKED = ("ads-track.**", "*.ads-track.**", "*/track?php**", "*/login/**", "**.exe")


class Automaton:
    """Masks of all patterns. In a pattern, ``[`` takes the next character literally."""

    def __init__(self, patterns: Iterable[str]) -> None:
        fits: list[set[int]] = []
        stays: list[int] = []  # 0: on nothing, 1: on all but a slash, 2: on anything
        starts, self.accept = [], []
        for pattern in patterns:
            starts.append(len(fits))
            fits.append(set())
            stays.append(0)
            raw = iter(pattern.encode())
            for byte in raw:
                if byte == ord("*"):
                    stays[-1] = min(stays[-1] + 1, 2)
                    continue
                if byte == ord("["):
                    fits.append({next(raw)})
                else:
                    fits.append(set(range(256)) if byte == ord("?") else {byte})
                stays.append(0)
            self.accept.append(len(fits) - 1)
        self.words = len(fits) // WORD_BITS + 1
        self.masks = np.zeros((256, self.words), np.uint64)
        for state, own in enumerate(fits):
            for byte in own:
                self.set(self.masks[byte], state)
        self.loop = np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        for state, kind in enumerate(stays):
            for byte in range(256):
                if kind == 2 or kind == 1 and byte != ord("/"):
                    self.set(self.loop[byte], state)
        for state in starts:
            self.set(self.start, state)

    @staticmethod
    def set(words: np.ndarray, state: int) -> None:
        words[state // WORD_BITS] |= np.uint64(1 << state % WORD_BITS)

    def run(self, texts: list[bytes]) -> np.ndarray:
        """Which pattern fits which whole text: one row per text, one column per pattern."""
        out = np.zeros((len(texts), len(self.accept)), bool)
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        at = 0
        while at < len(order):
            width = len(texts[order[at]]) + 1
            block = order[at : at + max(1, BLOCK_BYTES // width)]
            out[block] = self.run_block([texts[i] for i in block])
            at += len(block)
        return out

    def run_block(self, texts: list[bytes]) -> np.ndarray:
        """The same for texts in falling order of length."""
        lengths = np.array([len(text) for text in texts])
        state = np.tile(self.start, (len(texts), 1))
        padded = np.zeros((len(texts), int(lengths[0])), np.uint8)
        for row, text in zip(padded, texts):
            row[: len(text)] = np.frombuffer(text, np.uint8)
        going = len(texts)
        for at in range(int(lengths[0])):
            while lengths[going - 1] <= at:
                going -= 1
            now = state[:going]
            moved = now << np.uint64(1)  # a bit that leaves a pattern finds no mask for a start
            moved[:, 1:] |= now[:, :-1] >> np.uint64(WORD_BITS - 1)
            byte = padded[:going, at]
            state[:going] = moved & self.masks[byte] | now & self.loop[byte]
        accept = np.array(self.accept)
        return (state[:, accept // WORD_BITS] >> (accept % WORD_BITS).astype(np.uint64) & np.uint64(1)).astype(bool)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z in lower case; else empty."""
    rest = F.substring_index(F.substring_index(F.substring_index(after_scheme(url), "/", 1), "?", 1), "#", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def path_of(url: Column) -> Column:
    """From the end of the host up to ``? #`` or the end."""
    rest = F.substring_index(F.substring_index(after_scheme(url), "?", 1), "#", 1)
    at = F.instr(rest, "/")
    return F.when(at > 0, F.substring(rest, at, F.length(rest))).otherwise("")


def judge(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: tuple[Rule, ...] = RULES,
    blocked: tuple[str, ...] = BLOCKED,
) -> DataFrame:
    """``id, host, path, rule, verdict``, one row per row of ``pages``.

    ``rule`` is the longest rule that fits, first named among equals, and its
    verdict holds. Where none fits, ``rule`` is null and the URL is blocked if
    one of the globs ``blocked`` fits, else allowed. A null URL, or one without
    ``://``, has an empty host and path, fits no rule and is allowed. Repeated
    rows repeat, an empty table gives no rows, other columns are not looked at.
    """
    globs = [glob for rule in rules for glob in rule.globs()]
    automaton = Automaton([*globs, *blocked])
    by_length = sorted(range(len(rules)), key=lambda i: -len(rules[i].text))

    @F.pandas_udf("struct<rule string, verdict string>")
    def decide(canonical: pd.Series) -> pd.DataFrame:
        fits = automaton.run([url.encode() for url in canonical])
        verdict = np.where(fits[:, len(globs) :].any(axis=1), "block", "allow").astype(object)
        rule = np.full(len(canonical), None, object)
        for number in reversed(by_length):
            own = fits[:, 2 * number : 2 * number + 2].any(axis=1)
            rule[own], verdict[own] = rules[number].text, rules[number].verdict
        return pd.DataFrame({"rule": rule, "verdict": verdict})

    url = F.coalesce(pages[url_col].cast("string"), F.lit(""))
    parts = pages.select(pages[id_col].alias(id_col), host_of(url).alias("host"), path_of(url).alias("path"))
    return parts.withColumn("decided", decide(F.concat("host", "path"))).select(
        id_col, "host", "path", "decided.rule", "decided.verdict"
    )

