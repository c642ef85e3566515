"""License scans: phrases, and license templates compiled into token automata."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from re import _parser

import pyarrow as pa
from pyspark.sql import DataFrame

from statuslight.llm.common import LOWER, id_and_text, utf8

#: every ASCII byte that is no digit or letter separates words
BLANKED = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in LOWER)

# fixed values: phrases and their labels
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# templates: <<beginOptional>> ... <<endOptional>> may be missing, <<var;match="...">> stands for words that match
TEMPLATES = {
    "mit-notice": '<<beginOptional>>This <<var;match="(software|work|project|code|file)">> is<<endOptional>> '
                  '<<var;match="(released|licensed|distributed|available)">> under <<beginOptional>>the terms of '
                  "<<endOptional>><<beginOptional>>the <<endOptional>>MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                 "<<beginOptional>>and associated documentation files<<endOptional>> (the \"Software\"), to deal in the Software without restriction",
    "apache-notice": 'Licensed under the Apache License, Version 2.0 <<beginOptional>>(the "License")<<endOptional>>',
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "gpl-notice": 'under the terms of <<beginOptional>>version <<var;match="[0-9]+">> of <<endOptional>>the GNU '
                  "<<beginOptional>><<var;match=\"(lesser|affero|library)\">> <<endOptional>>General Public License",
    "cc-by-notice": '<<var;match="(released|licensed|available)">> under <<beginOptional>>a <<endOptional>>'
                    '<<beginOptional>>Creative Commons <<endOptional>>CC BY <<beginOptional>><<var;match="(nc|nd|sa)">> '
                    '<<endOptional>><<var;match="[0-9]+ [0-9]+">>',
    "copyright-reserved": 'Copyright <<beginOptional>>(c) <<endOptional>><<var;match="[0-9]{4}( [0-9]{4})?">> '
                          '<<var;match=".{1,80}">> All rights reserved',
}

Words = list[bytes]


def words_of(text: bytes) -> Words:
    """Lower-cased runs of ASCII digits and letters and of all other characters beyond ASCII."""
    return text.translate(BLANKED).split()


@dataclass
class Automaton:
    """States are numbered; a state has moves by a word, by a run of variable words, or by nothing."""

    words: dict[int, dict[bytes, int]] = field(default_factory=dict)
    #: pattern, the most bytes it matches, next state
    runs: dict[int, tuple[re.Pattern, int, int]] = field(default_factory=dict)
    free: dict[int, list[int]] = field(default_factory=dict)
    last: int = 0

    def ends(self, words: Words, begin: int) -> set[int]:
        """Where the automaton accepts when it starts at word ``begin``."""
        seen, todo, found = set(), [(0, begin)], set()
        while todo:
            state, at = todo.pop()
            if (state, at) in seen:
                continue
            seen.add((state, at))
            if state == self.last:
                found.add(at)
            todo += [(s, at) for s in self.free.get(state, ())]
            if at < len(words) and words[at] in self.words.get(state, ()):
                todo.append((self.words[state][words[at]], at + 1))
            if state in self.runs:
                pattern, most, after = self.runs[state]
                size = -1
                for end in range(at, len(words) + 1):
                    size += len(words[end - 1]) + 1 if end > at else 0
                    if size > most:  # no longer run can match
                        break
                    if pattern.fullmatch(b" ".join(words[at:end])):
                        todo.append((after, end))
        return found

    def needed(self) -> bytes:
        """The longest word that every accepted text holds by its wording; empty if there is none."""

        def passes(without: bytes) -> bool:
            seen, todo = set(), [0]
            while todo:
                state = todo.pop()
                if state not in seen:
                    seen.add(state)
                    todo += self.free.get(state, [])
                    todo += [after for word, after in self.words.get(state, {}).items() if word != without]
                    todo += [self.runs[state][2]] if state in self.runs else []
            return self.last in seen

        return max(sorted(word for word in {w for moves in self.words.values() for w in moves} if not passes(word)), key=len, default=b"")

    def starts(self) -> set[bytes] | None:
        """The words an accepted text can begin with; None if that is open."""
        seen, todo, found = set(), [0], set()
        while todo:
            state = todo.pop()
            if state in seen:
                continue
            seen.add(state)
            if state == self.last:
                return None
            todo += self.free.get(state, [])
            found |= set(self.words.get(state, ()))
            if state in self.runs:
                given = re.fullmatch(rb"\(?([a-z0-9|]+)\)?", self.runs[state][0].pattern)
                if not given:
                    return None
                found |= set(given[1].split(b"|"))
        return found


def compile_template(template: str) -> Automaton:
    """The automaton of a template. Raises ValueError on markup that does not nest."""
    found, state, top, open_at = Automaton(), 0, 0, []
    for piece in re.split(r"(<<.*?>>)", template):
        if piece == "<<beginOptional>>":
            open_at.append(state)
        elif piece == "<<endOptional>>":
            if not open_at:
                raise ValueError("endOptional without beginOptional")
            # leave by a state of its own, so that the way around ends where the region does
            found.free.setdefault(open_at.pop(), []).append(top + 1)
            found.free.setdefault(state, []).append(top + 1)
            state = top = top + 1
        elif piece.startswith("<<var;"):
            match = re.search(r'match="(.*?)"', piece)
            if not match:
                raise ValueError(f"a replaceable region needs match: {piece}")
            if state in found.runs or state in found.words:
                found.free.setdefault(state, []).append(top + 1)
                state = top = top + 1
            pattern = match[1].encode()
            found.runs[state] = re.compile(pattern), _parser.parse(pattern).getwidth()[1], top + 1
            state = top = top + 1
        elif piece.startswith("<<"):
            raise ValueError(f"unknown markup: {piece}")
        else:
            for word in words_of(piece.encode()):
                found.words.setdefault(state, {})[word] = top + 1
                state = top = top + 1
    if open_at:
        raise ValueError("beginOptional without endOptional")
    found.last = state
    return found


def accepts(template: str, text: str) -> bool:
    """Whether the whole text is the template, with its mandatory wording word for word."""
    words = words_of(text.encode())
    return len(words) in compile_template(template).ends(words, 0)


def _phrase_starts(words: Words, phrase: list[bytes]) -> list[int]:
    found, at = [], -1
    while True:
        try:
            at = words.index(phrase[0], at + 1)
        except ValueError:
            return found
        if words[at : at + len(phrase)] == phrase:
            found.append(at)


class Scanner:
    """All phrases and templates, ready to scan texts."""

    def __init__(self, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES):
        self.phrases = [(words_of(p.encode()), label) for p, label in phrases.items()]
        self.templates = []
        for label, template in templates.items():
            automaton = compile_template(template)
            if automaton.starts() is None:
                raise ValueError(f"the template {label} can begin with any word")
            self.templates.append((label, automaton, automaton.starts(), automaton.needed()))

    def scan(self, text: bytes) -> tuple[int, list[int], list[str], list[str]]:
        """Number of words, starts of phrases, labels of phrases, labels of templates."""
        flat = text.translate(BLANKED)
        words = flat.split()
        starts, base, method = [], set(), set()
        for phrase, label in self.phrases:
            if all(w in flat for w in phrase) and (at := _phrase_starts(words, phrase)):
                starts += at
                base.add(label)
        for label, automaton, first, needed in self.templates:
            if needed in flat and any(automaton.ends(words, i) for i, w in enumerate(words) if w in first):
                method.add(label)
        return len(words), starts, sorted(base), sorted(method)


def scan_licenses(documents: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` of every row with an id.

    Phrases are counted at every place where their words stand in a row. A template adds
    its label where its automaton accepts a run of words anywhere in the text. The score
    is 1 with a template, 0.5 with phrases only, 0 without both. A null or empty text has
    no words; repeated rows are scanned each; other columns are ignored.
    """
    scanner = Scanner(phrases, templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scanner.scan(t) for t in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([n for n, _, _, _ in found], pa.int64()),
                    pa.array([len(s) for _, s, _, _ in found], pa.int64()),
                    pa.array([min(s, default=None) for _, s, _, _ in found], pa.int64()),
                    pa.array([max(s, default=None) for _, s, _, _ in found], pa.int64()),
                    pa.array([",".join(b) for _, _, b, _ in found]),
                    pa.array([",".join(sorted({*b, *m})) for _, _, b, m in found]),
                    pa.array([1.0 if m else 0.5 if b else 0.0 for _, _, b, m in found]),
                ],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    return id_and_text(documents).mapInArrow(
        run, "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"
    )
