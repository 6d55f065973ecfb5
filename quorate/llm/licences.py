"""Licence scan: an Aho-Corasick automaton over a text's words, and a shunting-yard parser for licence expressions.

Words: A-Z lower-cased, then runs of characters other than ASCII non-alphanumerics. The automaton runs once over
the words joined by blanks and finds all phrases, overlapping ones too. Base phrases give base labels; the
method adds labels for further notices and for the identifiers of each `SPDX-License-Identifier:` tag, whose
expression (identifiers, parentheses, AND, OR, WITH, `+`) is parsed and evaluated: an expression permits use if
one branch of its ORs has only permissive parts. Identifiers are those of IDENTIFIERS, with or without `+`, and
`LicenseRef-` names; WITH takes one licence on its left and one of EXCEPTIONS on its right. What follows a complete
expression on its line is ignored; any other tag gives the label `unparsed`.

score: 0 without any label; else 1 - product of (1 - weight) over the distinct labels and a further weight where
a parsed expression or notice restricts use (share-alike or non-commercial). Null texts count as empty; repeated rows
and keys are scanned each; an empty table gives no rows; other columns than key and text are ignored. The time for a
text is linear in its length, however many places it has.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate

import ahocorasick
from pyspark.sql import DataFrame

from quorate.llm.common import arrow_rows

#: Base phrases and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Further notices and their labels.
NOTICES = {
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "bsd 2 clause license": "bsd-2-clause",
    "bsd 3 clause license": "bsd-3-clause",
    "creative commons attribution sharealike": "cc-by-sa",
    "cc by sa": "cc-by-sa",
    "creative commons zero": "cc0",
    "public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
TAG = "spdx license identifier"
#: Families of identifiers that restrict use or sharing.
RESTRICTIVE = ("gpl", "lgpl", "agpl", "cc-by-nc", "cc-by-sa", "all-rights-reserved", "mpl", "sspl", "busl")
LABEL_WEIGHT, RESTRICTED_WEIGHT = 0.5, 0.6

#: Licence identifiers, lower-cased.
IDENTIFIERS = frozenset(
    "0bsd aal afl-2.1 afl-3.0 agpl-1.0 agpl-3.0 agpl-3.0-only agpl-3.0-or-later apache-1.0 apache-1.1 apache-2.0 apsl-2.0 artistic-1.0 artistic-2.0 "
    "blueoak-1.0.0 bsd-1-clause bsd-2-clause bsd-2-clause-patent bsd-3-clause bsd-3-clause-clear bsd-4-clause bsl-1.0 busl-1.1 "
    "cc-by-1.0 cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0 cc-by-nc-1.0 cc-by-nc-2.0 cc-by-nc-3.0 cc-by-nc-4.0 cc-by-nc-nd-3.0 cc-by-nc-nd-4.0 "
    "cc-by-nc-sa-3.0 cc-by-nc-sa-4.0 cc-by-nd-3.0 cc-by-nd-4.0 cc-by-sa-2.0 cc-by-sa-2.5 cc-by-sa-3.0 cc-by-sa-4.0 cc0-1.0 cddl-1.0 cddl-1.1 "
    "cecill-2.1 cecill-b cecill-c cpl-1.0 ecl-2.0 epl-1.0 epl-2.0 eupl-1.1 eupl-1.2 fsfap ftl gfdl-1.2 gfdl-1.3 gfdl-1.3-only gfdl-1.3-or-later "
    "gpl-1.0 gpl-1.0-only gpl-1.0-or-later gpl-2.0 gpl-2.0-only gpl-2.0-or-later gpl-3.0 gpl-3.0-only gpl-3.0-or-later hpnd icu ijg ipl-1.0 isc "
    "lgpl-2.0 lgpl-2.0-only lgpl-2.0-or-later lgpl-2.1 lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0 lgpl-3.0-only lgpl-3.0-or-later libpng lppl-1.3c "
    "mit mit-0 mit-cmu mpl-1.0 mpl-1.1 mpl-2.0 mpl-2.0-no-copyleft-exception ms-pl ms-rl mulanpsl-2.0 ncsa odbl-1.0 ofl-1.0 ofl-1.1 openssl osl-3.0 "
    "pddl-1.0 php-3.01 postgresql psf-2.0 python-2.0 qpl-1.0 ruby sspl-1.0 tcl unicode-dfs-2016 unlicense upl-1.0 vim w3c wtfpl x11 zlib zpl-2.1".split()
)
#: Exceptions that may follow WITH, lower-cased.
EXCEPTIONS = frozenset(
    "autoconf-exception-2.0 autoconf-exception-3.0 bison-exception-2.2 classpath-exception-2.0 font-exception-2.0 gcc-exception-2.0 gcc-exception-3.1 "
    "libtool-exception linux-syscall-note llvm-exception ocaml-lgpl-linking-exception openjdk-assembly-exception-1.0 qt-gpl-exception-1.0 swift-exception".split()
)

#: ASCII letters to lower case, other ASCII non-alphanumerics to a blank, all else as it is.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
_EXPRESSION = re.compile(rb"spdx-license-identifier:[ \t]*([^\r\n]*)")
_TOKEN = re.compile(r"[()]|[a-z0-9.+_:-]+")
_PRIORITY = {"or": 1, "and": 2, "with": 3}


def folded_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def licence(token: str) -> bool:
    return token.removesuffix("+") in IDENTIFIERS or token.partition(":")[2].startswith("licenseref-") or token.startswith("licenseref-")


def parse(expression: str) -> list[str]:
    """Shunting-yard: the expression in reverse Polish order. ValueError if it isn't one."""
    out: list[str] = []
    operators: list[str] = []
    operand = True  # whether an operand is due
    before = ""
    for token in _TOKEN.findall(expression.lower()):
        previous, before = before, token
        if previous == "with":
            if token not in EXCEPTIONS:
                raise ValueError(f"{token} isn't an exception")
            out.append(token)
            operand = False
        elif token in _PRIORITY:
            if operand:
                raise ValueError(f"no operand before {token}")
            if token == "with" and not licence(previous):
                raise ValueError("an exception belongs to one licence")
            while operators and operators[-1] != "(" and _PRIORITY[operators[-1]] >= _PRIORITY[token]:
                out.append(operators.pop())
            operators.append(token)
            operand = True
        elif token == "(":
            if not operand:
                raise ValueError("no operator before a parenthesis")
            operators.append(token)
        elif token == ")":
            if operand:
                raise ValueError("no operand before a parenthesis")
            while operators and operators[-1] != "(":
                out.append(operators.pop())
            if not operators:
                raise ValueError("parenthesis without a match")
            operators.pop()
        elif not operand:
            break  # words after a complete expression, as in the tail of a comment
        elif licence(token):
            out.append(token)
            operand = False
        else:
            raise ValueError(f"{token} isn't a licence")
    while operators:
        if operand or operators[-1] == "(":
            raise ValueError("incomplete expression")
        out.append(operators.pop())
    if not out or operand:
        raise ValueError("incomplete expression")
    return out


def restrictive(identifier: str) -> bool:
    return any(identifier == x or identifier.startswith((f"{x}-", f"{x}+")) for x in RESTRICTIVE)


def evaluate(postfix: list[str]) -> bool:
    """Whether the expression permits use freely: OR needs one side, AND both; an exception (WITH) lifts a restriction."""
    stack: list[bool] = []
    for token in postfix:
        if token in _PRIORITY:
            right, left = stack.pop(), stack.pop()
            stack.append(left or right if token in ("or", "with") else left and right)
        else:
            stack.append(not restrictive(token))
    return stack[0]


def identifiers(postfix: list[str]) -> list[str]:
    """The licence identifiers, without exceptions' names."""
    out: list[tuple[str, ...]] = []
    for token in postfix:
        if token == "with":
            out.pop()
        elif token in _PRIORITY:
            out[-2:] = [out[-2] + out[-1]]
        else:
            out.append((token,))
    return sorted({x for part in out for x in part})


class Scanner:
    def __init__(self):
        self.automaton = ahocorasick.Automaton()
        for phrase, label in {**BASE_PHRASES, **NOTICES, TAG: None}.items():
            kind = "base" if phrase in BASE_PHRASES else "tag" if label is None else "notice"
            self.automaton.add_word(f" {phrase} ", (kind, label, len(phrase) + 2))
        self.automaton.make_automaton()

    def find(self, text: str | None) -> tuple[int, list[tuple[str, str | None, int]]]:
        """How many words the text has, and (kind, label, index of the first word) of each place."""
        words = folded_words(text)
        line = f" {b' '.join(words).decode('latin-1')} "
        places = [(kind, label, end - size + 1) for end, (kind, label, size) in self.automaton.iter(line)]
        if not places:
            return len(words), []
        starts = list(accumulate((len(w) + 1 for w in words), initial=0))  # of the words with the blank before each
        return len(words), [(kind, label, bisect_left(starts, at)) for kind, label, at in places]

    def scan(self, text: str | None) -> tuple:
        """(n_words, n_base, first_word, last_word, base_labels, labels, expressions, score)"""
        n_words, places = self.find(text)
        if not places:
            return n_words, 0, None, None, "", "", "", 0.0
        base = [(label, at) for kind, label, at in places if kind == "base"]
        labels = {label for _, label, _ in places if label}
        restricted = any(restrictive(x) for x in labels)
        seen = []
        if any(kind == "tag" for kind, _, _ in places):
            for found in _EXPRESSION.findall((text or "").encode("utf-8", "surrogatepass").lower()):
                try:
                    postfix = parse(found.decode("utf-8", "replace"))
                    names, free = identifiers(postfix), evaluate(postfix)
                except (ValueError, IndexError):
                    labels.add("unparsed")
                    continue
                labels.update(names)
                restricted |= not free
                seen.append(f"{' '.join(postfix)}={'free' if free else 'restricted'}")
        score = 1 - (1 - LABEL_WEIGHT) ** len(labels) * (1 - RESTRICTED_WEIGHT if restricted else 1) if labels else 0.0
        starts = [at for _, at in base]
        return (
            n_words, len(base), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for x, _ in base})), ",".join(sorted(labels)), "; ".join(seen), score,
        )


FIELDS = "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, expressions string, score double"
_scanner: list[Scanner] = []


def scan_documents(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Key and FIELDS of each row; `expressions` lists the parsed tags."""

    def scan(texts: list) -> list[list]:
        if not _scanner:
            _scanner.append(Scanner())
        return [list(x) for x in zip(*map(_scanner[0].scan, texts))]

    return arrow_rows(docs, [key], text, scan, FIELDS)
