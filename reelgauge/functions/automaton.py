"""Longest matches of many phrases in token lists, in one pass over each list."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Sequence


class TokenAutomaton:
    """An Aho-Corasick automaton over tokens. A state is a phrase's beginning; where the next token
    does not continue it, the failure link leads to the longest beginning that ends here too."""

    def __init__(self, phrases: Iterable[tuple[Sequence[str], int]]):
        self.steps: list[dict[str, int]] = [{}]
        self.value: list[int | None] = [None]
        self.depth = [0]
        for tokens, value in phrases:
            state = 0
            for token in tokens:
                after = self.steps[state].get(token)
                if after is None:
                    after = len(self.steps)
                    self.steps[state][token] = after
                    self.steps.append({})
                    self.value.append(None)
                    self.depth.append(self.depth[state] + 1)
                state = after
            if state:
                self.value[state] = value
        self._link()

    def _link(self) -> None:
        """Failure links, and for each state the nearest whole phrase along them."""
        self.fail, self.shorter = [0] * len(self.steps), [0] * len(self.steps)
        todo = deque(self.steps[0].values())
        while todo:
            state = todo.popleft()
            back = self.fail[state]
            self.shorter[state] = back if self.value[back] is not None else self.shorter[back]
            for token, after in self.steps[state].items():
                at = back
                while at and token not in self.steps[at]:
                    at = self.fail[at]
                self.fail[after] = self.steps[at].get(token, 0)
                todo.append(after)

    def matches(self, tokens: Sequence[str]) -> list[tuple[int, int, int]]:
        """(start, length, value) of the matches from left to right, the longest at each start;
        a token belongs to one match only."""
        longest: dict[int, tuple[int, int]] = {}
        state = 0
        for i, token in enumerate(tokens):
            while state and token not in self.steps[state]:
                state = self.fail[state]
            state = self.steps[state].get(token, 0)
            found = state if self.value[state] is not None else self.shorter[state]
            while found:
                size = self.depth[found]
                start = i + 1 - size
                if size > longest.get(start, (0, 0))[0]:
                    longest[start] = size, self.value[found]
                found = self.shorter[found]
        free, out = 0, []
        for start in sorted(longest):
            if start >= free:
                size, value = longest[start]
                out.append((start, size, value))
                free = start + size
        return out
