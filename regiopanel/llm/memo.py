"""Values of words, looked up again for words met before."""

from __future__ import annotations

from collections.abc import Callable

# Words that one worker remembers; beyond, it starts anew.
WORDS_KEPT = 1_000_000
# Characters whose words are looked up together.
CHUNK = 1_000_000


class Memo:
    """Remembers what ``encode_many`` gave for a word. A bound on memory, without effect on results."""

    def __init__(self, encode_many: Callable[[list[str]], list], limit: int = WORDS_KEPT):
        self.encode_many, self.limit, self.found = encode_many, limit, {}

    def __call__(self, words: list[str]) -> list:
        missing = set(words).difference(self.found)
        if missing:
            if len(self.found) + len(missing) > self.limit:
                self.found.clear()
                missing = set(words)
            missing = list(missing)
            self.found.update(zip(missing, self.encode_many(missing), strict=True))
        return list(map(self.found.__getitem__, words))


def in_chunks(text: str, blank: str, size: int = CHUNK):
    """Parts of a very long text, cut before a blank."""
    at = 0
    while len(text) - at > size:
        cut = text.find(blank, at + size)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]
