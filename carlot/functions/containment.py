"""E4 — which catalogue slug stands in an input, or holds it: an index over the catalogue's slugs.

One pass of an Aho-Corasick automaton finds all slugs inside an input; slugs around it are looked up
by their grams (the first slug of each one- or two-letter gram, all slugs of each three-letter one),
so neither side's substrings are listed.
"""

from __future__ import annotations

from collections.abc import Iterable

import ahocorasick

SHORT = 2


class SlugIndex:
    """Slugs in order: an input's hit is the first slug that it holds or that holds it."""

    def __init__(self, slugs: Iterable[str]):
        self.slugs = list(slugs)
        self.empty = next((i for i, s in enumerate(self.slugs) if not s), None)  # stands in every input
        self.automaton = ahocorasick.Automaton()
        self.first: dict[str, int] = {}
        self.grams: dict[str, list[int]] = {}
        for i, slug in enumerate(self.slugs):
            if slug and slug not in self.automaton:
                self.automaton.add_word(slug, i)
            for n in range(1, SHORT + 1):
                for k in range(len(slug) - n + 1):
                    self.first.setdefault(slug[k:k + n], i)
            for gram in {slug[k:k + 3] for k in range(len(slug) - 2)}:
                self.grams.setdefault(gram, []).append(i)
        if len(self.automaton):
            self.automaton.make_automaton()

    def inside(self, text: str) -> int | None:
        """First slug that stands in the text."""
        found = [i for _, i in self.automaton.iter(text)] if len(self.automaton) else []
        return min(found if self.empty is None else [*found, self.empty], default=None)

    def around(self, text: str) -> int | None:
        """First slug that the text stands in."""
        if len(text) <= SHORT:
            return self.first.get(text)
        lists = [self.grams.get(text[k:k + 3]) for k in range(len(text) - 2)]
        if not all(lists):
            return None
        return next((i for i in min(lists, key=len) if text in self.slugs[i]), None)

    def hit(self, text: str) -> int | None:
        return min((i for i in (self.inside(text), self.around(text)) if i is not None), default=None)
