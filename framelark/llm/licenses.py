"""Licence notices and identifier tags in texts, with the expressions that tags hold.

One Aho-Corasick automaton over normalised words finds notice phrases and tag markers together. What
follows a marker is read as a licence expression (and, or, with, brackets) by a shunting-yard parser and
evaluated: `or` needs one known licence, `and` both; `with` adds a known exception to a licence.
"""

import functools
import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from framelark.llm import common

# Fixed by the contract: phrases whose places count as base, and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Further notice phrases and labels.
PHRASES = {
    "permission is hereby granted free of charge to any person": "mit",
    "licensed under the apache": "apache",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "the unlicense": "unlicense",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "cc0": "cc0",
    "creative commons attribution": "cc-by",
    "all rights reserved": "proprietary",
}

# Licence identifiers of tags, by family.
FAMILIES = {
    "mit": "mit", "mit-0": "mit", "apache-2.0": "apache", "apache-1.1": "apache", "gpl-2.0": "gpl", "gpl-3.0": "gpl", "lgpl-2.1": "lgpl", "lgpl-3.0": "lgpl", "agpl-3.0": "agpl",
    "mpl-2.0": "mpl", "bsd-2-clause": "bsd", "bsd-3-clause": "bsd", "0bsd": "bsd", "isc": "isc", "epl-2.0": "epl", "bsl-1.0": "bsl", "unlicense": "unlicense", "zlib": "zlib", "cc0-1.0": "cc0",
    "cc-by-4.0": "cc-by", "cc-by-sa-4.0": "cc-by-sa", "cc-by-nc-4.0": "cc-by-nc", "cc-by-nd-4.0": "cc-by-nd",
}
EXCEPTIONS = frozenset(("classpath-exception-2.0", "gcc-exception-3.1", "llvm-exception", "linux-syscall-note", "bison-exception-2.2", "font-exception-2.0"))
MARKERS = ("spdx license identifier", "license expression")
_WEIGHT = {"tag": 1.0, "base": 0.9, "phrase": 0.7, "broken": 0.4}

_TO_SPACE = bytes(c if c >= 0x80 or chr(c).isalnum() else 32 for c in range(256)).lower()
_TOKEN = re.compile(r"\s*([()]|[A-Za-z0-9][A-Za-z0-9.+-]*)")
_MARKER = re.compile(r"(?:spdx[^0-9a-z\x80-\U0010ffff]+license[^0-9a-z\x80-\U0010ffff]+identifier|license[^0-9a-z\x80-\U0010ffff]+expression)[^\S\n]*:?[^\S\n]*", re.I | re.A)
_RANK = {"or": 1, "and": 2, "with": 3}


def expression_tokens(line: str, at=0, end=None) -> list:
    """Leading tokens of the expression at `at`: operators in lower case, names, brackets; stops at what cannot follow."""
    out, depth, want, end = [], 0, True, len(line) if end is None else end
    while m := _TOKEN.match(line, at, end):
        t = m[1]
        word = t.lower()
        if want:
            if word in _RANK or t == ")":
                break
            depth += t == "("
            want = t == "("
        else:
            if t == ")" and depth:
                depth -= 1
            elif word in _RANK:
                want = True
            else:
                break
        out.append(word)
        at = m.end()
    while out and (out[-1] in _RANK or out[-1] == "("):  # an operator or bracket that nothing follows
        depth -= out.pop() == "("
    return out


def postfix(tokens) -> list | None:
    """Shunting yard: tokens in postfix order, or None if brackets or operands do not fit."""
    out, stack, operands = [], [], 0
    for t in tokens:
        if t == "(":
            stack.append(t)
        elif t == ")":
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                return None
            stack.pop()
        elif t in _RANK:
            while stack and stack[-1] != "(" and _RANK[stack[-1]] >= _RANK[t]:
                out.append(stack.pop())
            stack.append(t)
        else:
            out.append(t)
            operands += 1
    while stack:
        if stack[-1] == "(":
            return None
        out.append(stack.pop())
    return out if operands and operands == 1 + sum(t in _RANK for t in out) else None


def _family(name):
    return FAMILIES.get(name.removesuffix("+").removesuffix("-only").removesuffix("-or-later"))


def evaluate(tokens):
    """(families named by the expression, whether it is satisfied), or None where it does not parse.

    `or` is satisfied by one side; the families of a side that is not known do not count for it.
    """
    order, stack = postfix(tokens), []
    if order is None:
        return None
    for t in order:
        if t not in _RANK:
            family = _family(t)
            stack.append((frozenset((family,)) if family else frozenset(), family is not None, t))
            continue
        if len(stack) < 2:
            return None
        (b, b_ok, name), (a, a_ok, _) = stack.pop(), stack.pop()
        if t == "with":
            stack.append((a, a_ok and name in EXCEPTIONS, ""))
        elif t == "and":
            stack.append((a | b, a_ok and b_ok, ""))
        else:
            stack.append(((a if a_ok else frozenset()) | (b if b_ok else frozenset()), a_ok or b_ok, ""))
    return stack[0][:2] if len(stack) == 1 else None


@functools.lru_cache(maxsize=1)
def _automaton():
    a = ahocorasick.Automaton()
    for phrase in {*BASE, *PHRASES, *MARKERS}:
        a.add_word(f" {phrase} ", phrase)
    a.make_automaton()
    return a


def scan(text: bytes):
    """(n_words, base starts, base labels, labels, score) of one UTF-8 text."""
    words = text.translate(_TO_SPACE).split()
    starts, base, labels, best = [], set(), set(), 0.0
    line = " " + b" ".join(words).decode("utf-8", "replace") + " "
    markers, spaces = False, None
    for end, phrase in _automaton().iter(line):
        if phrase in BASE:
            if spaces is None:
                spaces = np.flatnonzero(np.frombuffer(line.encode("utf-32-le"), np.uint32) == 32)
            starts.append(int(np.searchsorted(spaces, end - len(phrase))) - 1)
            base.add(BASE[phrase])
            best = max(best, _WEIGHT["base"])
        if phrase in PHRASES:
            labels.add(PHRASES[phrase])
            best = max(best, _WEIGHT["phrase"])
        markers |= phrase in MARKERS
    if markers:
        whole = text.decode("utf-8", "replace")
        end = -1
        for m in _MARKER.finditer(whole):
            if end < m.end():
                end = whole.find("\n", m.end())
                end = len(whole) if end < 0 else end
            found = evaluate(expression_tokens(whole, m.end(), end))
            if found is not None:
                labels |= found[0]
                best = max(best, _WEIGHT["tag"] if found[1] else _WEIGHT["broken"])
    return len(words), starts, base, base | labels, best


def _scan_rows(batches):
    for b in common.blocks(batches):
        rows = [scan(t) for t in common.raw(b.column("text"))]
        at = [np.array(r[1], np.int64) for r in rows]
        join = lambda i: pa.array([",".join(sorted(r[i])) for r in rows], pa.string())  # noqa: B023, E731
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array([r[0] for r in rows], pa.int64()), pa.array([len(x) for x in at], pa.int64()),
             pa.array([int(x.min()) if len(x) else None for x in at], pa.int64()), pa.array([int(x.max()) if len(x) else None for x in at], pa.int64()),
             join(2), join(3), pa.array([r[4] for r in rows], pa.float64())],
            ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])


def scan_licenses(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words are runs of letters and digits (and all beyond ASCII) with A-Z in lower case. The score is that of
    the surest find: 1 for a tag whose expression is satisfied, 0.9 for a base phrase, 0.7 for another
    phrase, 0.4 for a tag that names no known licence, else 0. Null and empty texts have no words: first_word and
    last_word are null, the labels empty. A text is scanned whole, in time linear in its length (searches for the
    place of a find take a logarithm more), and held in its task with a number per word where a base phrase stands.
    """
    rows = common.columns(docs, doc_id=id_col, text=text_col)
    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"
    return rows.mapInArrow(_scan_rows, schema)
