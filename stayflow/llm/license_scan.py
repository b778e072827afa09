"""License scan: notices and identifier tags.

One Aho-Corasick automaton finds notice phrases and the identifier tag in the
words of a text.  The expression behind a tag is read from the raw text and
evaluated by a shunting-yard parser over ``and``, ``or``, ``with`` and
parentheses (``with`` binds tightest, then ``and``, then ``or``).

Words: maximal runs of 0-9, a-z (A-Z lower-cased) and non-ASCII characters.

score: 0 to 1, how freely the text may be used: 1 for no restriction, 0 for
none found or all rights reserved.  In an expression ``or`` takes the freer
side, ``and`` the stricter one, ``with`` the freer of licence and exception
clause; several notices in one text all hold, so the strictest counts.

Null text is the empty text: no words, null first_word and last_word, empty
labels, score 0.  A malformed expression gives the labels of the identifiers
that it names, and the strictest of their scores.
"""

from __future__ import annotations

import re

import ahocorasick
from pyspark.sql import DataFrame

from .common import id_text, map_rows

# Notice phrases and their labels; the first three are the base.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
MORE_PHRASES = {
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "bsd 2 clause": "bsd",
    "bsd 3 clause": "bsd",
    "isc license": "isc",
    "cc by sa": "cc-by-sa",
    "cc0 1 0": "cc0",
    "dedicated to the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
# How freely a labelled text may be used, 0 to 1.
FREEDOM = {"mit": 1.0, "bsd": 1.0, "isc": 1.0, "cc0": 1.0, "public-domain": 1.0, "apache-2": 0.9, "cc-by": 0.9,
           "mpl": 0.6, "lgpl": 0.6, "cc-by-sa": 0.5, "gpl": 0.4, "agpl": 0.3, "cc-by-nc": 0.2,
           "all-rights-reserved": 0.0}
UNKNOWN, EXCEPTION = 0.1, 0.7
# Exceptions that let other works link to one under a copyleft licence.
EXCEPTIONS = frozenset("""classpath-exception-2.0 gcc-exception-2.0 gcc-exception-3.1 llvm-exception linux-syscall-note
autoconf-exception-2.0 autoconf-exception-3.0 bison-exception-2.2 font-exception-2.0 libtool-exception
openjdk-assembly-exception-1.0 ocaml-lgpl-linking-exception wxwindows-exception-3.1 qt-lgpl-exception-1.1
universal-foss-exception-1.0 u-boot-exception-2.0 freertos-exception-2.0 i2p-gpl-java-exception""".split())
COPYLEFT = frozenset(("gpl", "lgpl", "agpl", "mpl"))
# Identifiers and their labels, longest first where one starts another; a
# version and the words of SUFFIX may follow.
IDENTIFIERS = (("apache-2", "apache-2"), ("cc-by-nc", "cc-by-nc"), ("cc-by-sa", "cc-by-sa"), ("cc-by", "cc-by"),
               ("cc0", "cc0"), ("lgpl", "lgpl"), ("agpl", "agpl"), ("gpl", "gpl"), ("mpl", "mpl"), ("bsd", "bsd"),
               ("0bsd", "bsd"), ("isc", "isc"), ("mit", "mit"), ("unlicense", "public-domain"))
TAG = re.compile(r"spdx-license-identifier:[\x20\t]*([^\n]*)", re.I | re.A)
TOKEN = re.compile(r"[()]|[A-Za-z0-9.+:-]+")
BINDS = {"or": 1, "and": 2, "with": 3}

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))


SUFFIX = re.compile(r"(?:v?\d*(?:\.\d+)*)(?:-(?:v?\d[\d.]*|only|or-later|clause|universal|patent|clear|no-attribution|nc|nd|sa"
                    r"|igo|[a-z]{2}))*\+?")


def label_of(identifier: str) -> str:
    """The label of a whole identifier; of an unknown one its own name."""
    name = identifier.lower()
    known = (label for start, label in IDENTIFIERS if name.startswith(start) and SUFFIX.fullmatch(name, len(start)))
    return next(known, name.rstrip("+"))


def excepted(labels: set[str], score: float, exception: str) -> float:
    """A known exception loosens a copyleft licence; any other changes nothing."""
    return max(score, EXCEPTION) if exception.lower() in EXCEPTIONS and labels <= COPYLEFT else score


class Malformed(ValueError):
    pass


def postfix(tokens: list[str]) -> list[str]:
    """Shunting-yard: operators after their operands."""
    out: list[str] = []
    stack: list[str] = []
    operand = True  # an operand must come next
    for t in tokens:
        op = t.lower()
        if op in BINDS:
            if operand:
                raise Malformed(t)
            while stack and stack[-1] != "(" and BINDS[stack[-1]] >= BINDS[op]:
                out.append(stack.pop())
            stack.append(op)
            operand = True
        elif t == "(":
            if not operand:
                raise Malformed(t)
            stack.append(t)
        elif t == ")":
            if operand:
                raise Malformed(t)
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                raise Malformed(t)
            stack.pop()
        else:
            if not operand:
                raise Malformed(t)
            out.append(t)
            operand = False
    if operand or "(" in stack:
        raise Malformed("end")
    return out + stack[::-1]


def evaluate(expression: str) -> tuple[set[str], float]:
    """Labels and score of one licence expression."""
    tokens = TOKEN.findall(expression)
    # Prose after the expression ends it: two operands in a row.
    for k in range(1, len(tokens)):
        ends = tokens[k - 1] == ")" or tokens[k - 1] != "(" and tokens[k - 1].lower() not in BINDS
        if ends and tokens[k] != ")" and tokens[k].lower() not in BINDS:
            tokens = tokens[:k]
            break
    try:
        stack: list[tuple[set[str], float, str]] = []
        for t in postfix(tokens):
            if t in BINDS:
                (rl, rs, rt), (ll, ls, _) = stack.pop(), stack.pop()
                stack.append((ll, excepted(ll, ls, rt), "") if t == "with"
                             else (ll | rl, max(ls, rs) if t == "or" else min(ls, rs), ""))
            else:
                stack.append(({label_of(t)}, FREEDOM.get(label_of(t), UNKNOWN), t))
        return stack[0][:2]
    except Malformed:
        names = {label_of(t) for t in tokens if t not in "()" and t.lower() not in BINDS}
        return names, min((FREEDOM.get(x, UNKNOWN) for x in names), default=0.0)


class Scanner:
    def __init__(self, base: dict[str, str], more: dict[str, str]):
        self.automaton = ahocorasick.Automaton()
        for is_base, phrases in ((True, base), (False, more), (False, {"spdx license identifier": ""})):
            for phrase, label in phrases.items():
                self.automaton.add_word(f" {phrase} ", (phrase.count(" ") + 2, label, is_base))
        self.automaton.make_automaton()

    def row(self, text: str) -> tuple:
        """(n_words, n_base, first_word, last_word, base labels, labels, score)."""
        words = text.encode().translate(_FOLD).split()
        line = f" {b' '.join(words).decode('latin-1')} "
        starts, base, labels, scores, tagged = [], set(), set(), [], False
        spaces = at = 0  # before ``at``
        for end, (own_spaces, label, is_base) in self.automaton.iter(line):
            if is_base:
                spaces, at = spaces + line.count(" ", at, end + 1), end + 1
                starts.append(spaces - own_spaces)
                base.add(label)
            if label:
                labels.add(label)
                scores.append(FREEDOM.get(label, UNKNOWN))
            else:
                tagged = True
        if tagged:
            for m in TAG.finditer(text):
                found, score = evaluate(m[1])
                if found:
                    labels |= found
                    scores.append(score)
        return (len(words), len(starts), min(starts, default=None), max(starts, default=None),
                ",".join(sorted(base)), ",".join(sorted(labels)), min(scores, default=0.0))


def scan(docs: DataFrame, base: dict[str, str] = BASE_PHRASES, more: dict[str, str] = MORE_PHRASES,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    def make():
        scanner = Scanner(base, more)
        return lambda doc, text: (doc, *scanner.row(text or ""))
    return map_rows(id_text(docs, id_col, text_col), make,
                    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
                    "base_labels string, labels string, score double")
