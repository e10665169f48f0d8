"""License signatures: ordered rules over normalised words.

A pattern is a sequence of word units: a plain word, ``(a|b)`` for a choice,
``[a]`` for an optional unit (also ``[a|b]``), ``#`` for a number, ``*`` for any
word, ``~n`` for up to n words of any kind. Rules with a greater level win over
rules that they contain; ``keyword`` is a word that any match holds.
"""

from __future__ import annotations

import re
from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    level: int  # 1 weak hint, 2 name, 3 name with version or notice, 4 full notice
    score: float
    keyword: str
    pattern: str


#: Any match of any rule holds one of these; a text without them is not looked at further.
GATE = (
    r"(?i)licen[cs]|copyright|reserved|public[^0-9a-z]+domain|commons|spdx|hereby|redistribution|unencumbered|permission|provided|proprietary"
    r"|(?:^|[^0-9a-z])(?:[al]?gplv?|gfdlv?|mpl|epl|eupl|cddl|ofl|odbl|lppl|psf|wtfpl|bsd|cc0?)(?:[^a-z]|$)"
)

#: The base phrases of the contract and their labels.
BASE = (("gpl", "gnu general public license"), ("apache", "apache license"), ("cc-by", "cc by"), ("mit", "mit license"))


def _gnu() -> list[Rule]:
    """GNU family: names, acronyms, notices, by version."""
    rules = []
    for label, name, acronym, versions in (
        ("gpl", "gnu general public (license|licence)", "gpl", "123"),
        ("lgpl", "gnu (lesser|library) general public (license|licence)", "lgpl", "23"),
        ("agpl", "gnu affero general public (license|licence)", "agpl", "13"),
        ("gfdl", "gnu free documentation (license|licence)", "gfdl", "1"),
    ):
        key = {"gpl": "general", "lgpl": "general", "agpl": "affero", "gfdl": "documentation"}[label]
        rules += [
            Rule(label, 2, 0.9, key, name),
            Rule(label, 2, 0.6, acronym, f"{acronym} (license|licence|licensed)"),
            Rule(label, 2, 0.6, acronym, f"(license|licensed|licence) ~2 {acronym}"),
            Rule(label, 3, 0.95, key, f"(licensed|released|distributed|covered|available) under ~2 the {name}"),
            Rule(label, 3, 0.95, key, f"under the terms of the {name}"),
        ]
        for v in versions:
            rules += [
                Rule(f"{label}-{v}", 3, 1.0, key, f"{name} [the] (version|v) {v} [0]"),
                Rule(f"{label}-{v}", 3, 1.0, key, f"{name} v{v}"),
                Rule(f"{label}-{v}", 3, 0.9, acronym, f"{acronym} [version|v] {v} [0]"),
                Rule(f"{label}-{v}", 3, 0.9, f"{acronym}v{v}", f"{acronym}v{v}"),
                Rule(f"{label}-{v}-or-later", 4, 1.0, key, f"{name} ~3 version {v} [0] ~4 or at your option any later version"),
                Rule(f"{label}-{v}-or-later", 4, 1.0, key, f"{name} (version|v) {v} [0] or [any] later"),
                Rule(f"{label}-{v}-or-later", 4, 1.0, acronym, f"spdx license identifier {acronym} {v} 0 (or later|plus)"),
                Rule(f"{label}-{v}-only", 4, 1.0, acronym, f"spdx license identifier {acronym} {v} 0 only"),
            ]
    return rules


def _creative_commons() -> list[Rule]:
    """Creative Commons: every mix of conditions, short and spelled out, with and without versions."""
    words = {"by": "attribution", "nc": "(noncommercial|non commercial)", "sa": "(sharealike|share alike)", "nd": "(noderivatives|noderivs|no derivatives|no derivs)"}
    rules = []
    for terms in ("by", "by nc", "by sa", "by nd", "by nc sa", "by nc nd"):
        label = "cc-" + terms.replace(" ", "-")
        spelled = " ".join(words[t] for t in terms.split())
        rules += [
            Rule(label, 2, 0.9, "cc", f"cc {terms}"),
            Rule(label, 3, 0.95, "cc", f"(licensed|released|available|distributed) under [a] [the] cc {terms} [license|licence]"),
            Rule(label, 3, 1.0, "commons", f"creative commons {spelled} [license|licence]"),
            Rule(label, 3, 0.95, "creativecommons", f"creativecommons org licenses {terms}"),
        ]
        for v in ("1 0", "2 0", "2 5", "3 0", "4 0"):
            rules += [
                Rule(f"{label}-{v.replace(' ', '.')}", 4, 1.0, "cc", f"cc {terms} {v}"),
                Rule(f"{label}-{v.replace(' ', '.')}", 4, 1.0, "commons", f"creative commons {spelled} {v} ~1 [license|licence]"),
            ]
    return [
        *rules,
        Rule("cc0", 3, 1.0, "cc0", "cc0 [1] [0]"),
        Rule("cc0", 3, 1.0, "commons", "creative commons zero"),
        Rule("creative-commons", 1, 0.5, "commons", "creative commons"),
    ]


def _numbered() -> list[Rule]:
    """Families with a name, an acronym and versions."""
    rules = []
    for label, name, acronym, versions in (
        ("apache", "apache (license|licence)", "", ("1 0", "1 1", "2 0")),
        ("mpl", "mozilla public (license|licence)", "mpl", ("1 0", "1 1", "2 0")),
        ("epl", "eclipse public (license|licence)", "epl", ("1 0", "2 0")),
        ("eupl", "european union public (license|licence)", "eupl", ("1 0", "1 1", "1 2")),
        ("cddl", "common development and distribution (license|licence)", "cddl", ("1 0", "1 1")),
        ("cpl", "common public (license|licence)", "", ("1 0",)),
        ("ofl", "open font (license|licence)", "ofl", ("1 0", "1 1")),
        ("odbl", "open database (license|licence)", "odbl", ("1 0",)),
        ("artistic", "artistic (license|licence)", "", ("1 0", "2 0")),
        ("osl", "open software (license|licence)", "", ("1 0", "2 0", "2 1", "3 0")),
        ("afl", "academic free (license|licence)", "", ("1 1", "2 0", "2 1", "3 0")),
        ("lppl", "latex project public (license|licence)", "lppl", ("1 0", "1 2", "1 3")),
        ("ms-pl", "microsoft public (license|licence)", "", ()),
        ("boost", "boost software (license|licence)", "", ("1 0",)),
        ("zlib", "zlib (license|licence)", "", ()),
        ("isc", "isc (license|licence)", "", ()),
        ("python", "python software foundation (license|licence)", "psf", ("2",)),
        ("openssl", "openssl (license|licence)", "", ()),
        ("php", "php (license|licence)", "", ("3 0", "3 01")),
        ("qpl", "q public (license|licence)", "", ("1 0",)),
        ("unlicense", "the unlicense", "", ()),
        ("wtfpl", "do what the fuck you want to public (license|licence)", "wtfpl", ()),
    ):
        key = max(re.findall(r"[a-z]+", name.split("(")[0]), key=len)
        rules += [
            Rule(label, 2, 0.9, key, name),
            Rule(label, 3, 0.95, key, f"(licensed|released|distributed|available) under the {name}"),
        ]
        if acronym:
            rules.append(Rule(label, 2, 0.6, acronym, f"{acronym} [license|licence|licensed]"))
        for v in versions:
            dotted = v.replace(" ", ".")
            rules.append(Rule(f"{label}-{dotted}", 4, 1.0, key, f"{name} [the] [version|v] {v}"))
            if acronym:
                rules.append(Rule(f"{label}-{dotted}", 4, 1.0, acronym, f"{acronym} [version|v] {v}"))
    return rules


def _short() -> list[Rule]:
    """Permissive families told by their notices, and marks of reserved or given-up rights."""
    lic = "(license|licence)"
    return [
        Rule("mit", 2, 0.9, "mit", f"mit {lic}"),
        Rule("mit", 2, 0.8, "expat", f"expat {lic}"),
        Rule("mit", 3, 0.95, "mit", f"(released|licensed|distributed|available) under [the] [terms] [of] [the] mit {lic}"),
        Rule("mit", 3, 0.95, "mit", f"{lic} mit"),
        Rule("mit", 4, 1.0, "permission", "permission is hereby granted free of charge to any person obtaining a copy"),
        Rule("mit", 4, 1.0, "spdx", "spdx license identifier mit"),
        Rule("bsd", 2, 0.9, "bsd", f"bsd {lic}"),
        Rule("bsd", 2, 0.8, "bsd", f"bsd style {lic}"),
        Rule("bsd-2", 3, 1.0, "bsd", "(bsd 2 clause|2 clause bsd|simplified bsd) [license|licence]"),
        Rule("bsd-3", 3, 1.0, "bsd", "bsd 3 clause [license|licence]"),
        Rule("bsd-3", 3, 1.0, "bsd", "3 clause bsd [license|licence]"),
        Rule("bsd-3", 3, 1.0, "bsd", f"(new|revised|modified) bsd {lic}"),
        Rule("bsd-4", 3, 1.0, "bsd", f"(original|old) bsd {lic}"),
        Rule("bsd", 4, 1.0, "redistribution", "redistribution and use in source and binary forms with or without modification"),
        Rule("isc", 4, 1.0, "permission", "permission to use copy modify and or distribute this software for any purpose"),
        Rule("zlib", 4, 1.0, "provided", "this software is provided as is without any express or implied warranty"),
        Rule("boost", 4, 1.0, "boost", "distributed under the boost software license"),
        Rule("public-domain", 2, 0.8, "public", "(in|into|to) the public domain"),
        Rule("public-domain", 3, 0.9, "public", "dedicated to the public domain"),
        Rule("unlicense", 4, 1.0, "unencumbered", "this is free and unencumbered software released into the public domain"),
        Rule("beerware", 2, 0.9, "beer", f"beer ware {lic}"),
        Rule("proprietary", 2, 0.7, "proprietary", "proprietary [and] [confidential] (license|licence|software|information)"),
        Rule("proprietary", 2, 0.7, "reserved", "all rights reserved"),
        Rule("proprietary", 3, 0.8, "reserved", "copyright ~8 all rights reserved"),
        Rule("copyright", 1, 0.3, "copyright", "copyright [c] #"),
        Rule("eula", 2, 0.8, "user", f"end user {lic} agreement"),
        Rule("commercial", 2, 0.7, "commercial", f"commercial {lic}"),
        Rule("unknown-license", 1, 0.3, "licensed", "licensed under"),
        Rule("unknown-license", 1, 0.3, "licenced", "licenced under"),
        Rule("unknown-license", 1, 0.3, "terms", f"terms of the [*] {lic}"),
        Rule("unknown-license", 1, 0.3, "see", f"see [the] {lic} [file]"),
    ]


RULES: tuple[Rule, ...] = (*_gnu(), *_creative_commons(), *_numbered(), *_short())


def regex(pattern: str) -> str:
    """The pattern over words that stand as ' word ' one after the other."""
    out = []
    for token in re.findall(r"\[[^\]]*\]|\([^)]*\)|\S+", pattern):
        body = token.strip("[]()") if token[0] in "[(" else token
        if token[0] == "~":
            out.append(f"(?: [^ ]+ ){{0,{token[1:]}}}")
            continue
        choices = ["".join(" [0-9]+ " if w == "#" else " [^ ]+ " if w == "*" else f" {w} " for w in c.split()) for c in body.split("|")]
        unit = choices[0] if len(choices) == 1 else f"(?:{'|'.join(choices)})"
        out.append(f"(?:{unit})?" if token[0] == "[" else unit)
    return "".join(out)
