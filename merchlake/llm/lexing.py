"""Name-literal pairs of source and configuration texts, and which literals end up under which names.

One lexer serves all languages: strings, names, assignment signs and brackets look alike in most of
them. A pair is a definition; names in its value refer to the latest earlier definition of that name,
so constants are followed from where they are written to where they are used.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from typing import NamedTuple

# Words that make a name sensitive, and the share of certainty they carry.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 1.0, "secret": 1.0, "secrets": 1.0, "token": 1.0, "apikey": 1.0,
    "credential": 1.0, "credentials": 1.0, "authorization": 1.0, "bearer": 1.0, "passcode": 1.0, "pass": 0.9, "auth": 0.9,
    "privatekey": 1.0, "accesskey": 1.0, "secretkey": 1.0, "authtoken": 1.0, "salt": 0.7, "cookie": 0.7,
}
# What stands before "key" in a key that must stay secret.
KEYS = {"api", "access", "private", "secret", "signing", "encryption", "master", "service", "account", "auth", "client", "session", "shared", "storage", "license", "deploy"}
# Last words of names that speak about a secret and do not hold it.
ABOUT = {
    "count", "counts", "length", "len", "size", "limit", "max", "min", "url", "uri", "path", "file", "filename", "name", "type",
    "field", "label", "regex", "pattern", "hint", "expiry", "expires", "ttl", "policy", "prompt", "placeholder", "header", "id",
    "ids", "index", "format", "version", "enabled", "required", "timeout", "endpoint", "provider", "manager", "class", "error",
    "message", "text", "title", "description", "column", "algorithm", "method", "mode", "scope",
}
# Calls that hand their argument on in another form.
WRAPPERS = {"str", "bytes", "string", "b64decode", "decode", "encode", "unhexlify", "fromhex", "strip", "trim", "from", "atob", "secretstr", "quote", "bytearray", "tobytes", "getbytes"}
# Calls that look a name up and may give a default.
LOOKUPS = {"getenv", "get", "env", "environ", "getproperty", "pop", "setdefault", "config", "putenv", "setenv", "set", "put"}
PLACEHOLDER = re.compile(
    r"(?i)(?:[x*.#_-]+|<.*>|\$\{.*\}|\{+.*\}+|%\w*%?|.*your[_-].*|.*example.*|.*change[_-]?me.*|.*placeholder.*|dummy.*|todo.*|redacted|undefined|password\d?)"
)
PLACE = re.compile(r"(?i)(?:[a-z][a-z0-9+.-]*://|/|\./|\.\./|~/|[a-z]:\\).*")

STEMS = re.compile(r"(?i:pass|pwd|secret|token|key|auth|credential|bearer|salt|cookie|://)", re.ASCII)

_TOKENS = re.compile(
    r"""
    (?P<string>(?:(?<!\w)[rbfuRBFU]{1,2}|(?<![\w\\]))
        (?:\"{3}(?s:.*?)\"{3} | '{3}(?s:.*?)'{3}
         | "[^"\\\n]*+(?:\\.[^"\\\n]*+)*+"? | '[^'\\\n]*+(?:\\.[^'\\\n]*+)*+'? | `[^`\n]*+`?))
  | (?P<name>\$?\{?(?:[^\W\d]\w*+)(?:(?:[.-]|->|::)\w++)*+\}?)
  | (?P<sign>:=|=>|\+=|\.=|[=!<>]=+|[=:])
  | (?P<line>\n)
  | (?P<other>[^\s\w]|\w++)
    """,
    re.VERBOSE,
)
_ASSIGNS = {"=", ":=", ":", "=>", "+=", ".="}
_INSIDE = re.compile(r"\$\{?([A-Za-z_]\w*)\}?|\{([A-Za-z_][\w.]*)\}|%\(([A-Za-z_]\w*)\)s")
_BEARER = re.compile(r"(?i)(?:bearer|basic|token)[ ]+(\S+)$")
#: What may stand before a name that begins its line, and a value without quotes up to the line's end.
_OPENS = re.compile(r"[\s#;/*-]*(?:(?:export|set|setx|env|arg|const|let|var|val|final|public|private|static|string)\s+)*[\"']?", re.IGNORECASE)
_BARE = re.compile(r"[ \t]*+([^\s\"'`(){}\[\],;<>]++)[ \t]*+(?:[,;][ \t]*+)?(?:(?:(?<=\s)#|//).*)?$")
_ELEMENT = re.compile(r"<([A-Za-z_][\w.:-]*+)(?:\s[^<>]*+)?>([^<>\n]*+)</\1\s*>")
_USERINFO = re.compile(r"://[^\s/:@\"'<>]*+:([^\s/@\"'<>]++)@")
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


class Literal(NamedTuple):
    text: str
    start: int
    end: int


class Evidence(NamedTuple):
    """What a value looks like: its length (at most ENOUGH), kinds of characters as bits, entropy per character."""

    length: int
    kinds: int
    entropy: float


ENOUGH = 1_000_000
NOTHING = Evidence(0, 0, 0.0)


class Definition:
    __slots__ = ("literals", "name", "uses")

    def __init__(self, name: str, literals: list[Literal], uses: list[int]):
        self.name, self.literals, self.uses = name, literals, uses


@functools.lru_cache(100_000)
def sensitivity(name: str) -> float:
    """How surely a name holds a secret, from 0 to 1: its words, unless the last one speaks about it."""
    words = [w.lower() for w in _WORDS.findall(name)]
    if not words or words[-1] in ABOUT:
        return 0.0
    keys = any(a in KEYS and b in ("key", "keys") for a, b in zip(words, words[1:], strict=False))
    return max(1.0 if keys else 0.0, *(SENSITIVE.get(w, 0.0) for w in words))


def evidence(text: str) -> Evidence:
    if not text:
        return NOTHING
    kinds = sum(1 << k for k, p in enumerate(("a-z", "A-Z", "0-9", "^a-zA-Z0-9_. -")) if re.search(f"[{p}]", text))
    n = len(text)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(text).values())
    return Evidence(min(n, ENOUGH), kinds, entropy)


def joined(parts: list[Evidence]) -> Evidence:
    kinds = 0
    for p in parts:
        kinds |= p.kinds
    return Evidence(min(sum(p.length for p in parts), ENOUGH), kinds, max((p.entropy for p in parts), default=0.0))


def plausibility(e: Evidence) -> float:
    """How much a value looks like a secret, from 0 to 1: eight characters at least, more than words."""
    if e.length < 8 or e.entropy < 2.0:
        return 0.0
    mixed = bool(e.kinds & 4) + bool(e.kinds & 3) == 2 or bool(e.kinds & 8)
    return 0.2 + 0.4 * mixed + 0.2 * (e.entropy >= 3.0) + 0.2 * (e.kinds.bit_count() >= 3)


def candidate(literal: Literal) -> bool:
    """Whether a literal can be a part of a secret: no blank, placeholder, address or path."""
    text = literal.text
    if len(text) < 3 or any(c.isspace() for c in text):
        return False
    return not PLACEHOLDER.fullmatch(text) and not PLACE.fullmatch(text)


class Lexer:
    """Definitions of one text, in order."""

    def __init__(self, text: str):
        self.text = text
        #: Where the current line begins.
        self._floor = 0
        self.tokens = [(m.lastgroup, m.group(), m.start(), m.end()) for m in _TOKENS.finditer(text)]
        self.latest: dict[str, int] = {}
        self.found: list[Definition] = []

    def _literal(self, token: tuple) -> Literal | None:
        """The content of a string; None for one that does not end on its line."""
        _, raw, start, _ = token
        opens = next(k for k, c in enumerate(raw) if c in "\"'`")
        quote = raw[opens:]
        width = 3 if quote[:3] in ('"""', "'''") and len(quote) >= 6 else 1
        if len(quote) < 2 * width or quote[-1] != quote[0]:
            return None
        first, last = start + opens + width, start + len(raw) - width
        bearer = _BEARER.match(self.text[first:last])
        if bearer:
            first, last = first + bearer.start(1), first + bearer.end(1)
        return Literal(self.text[first:last], first, last)

    def _kind(self, i: int) -> str | None:
        return self.tokens[i][0] if 0 <= i < len(self.tokens) else None

    def _word(self, i: int) -> str:
        return self.tokens[i][1] if 0 <= i < len(self.tokens) else ""

    def _target(self, i: int) -> tuple[str, int] | None:
        """The name that the sign at token ``i`` gives a value to, and its first token."""
        if self._kind(i - 1) == "string":
            literal = self._literal(self.tokens[i - 1])
            return (literal.text, i - 1) if literal else None
        if self._word(i - 1) == "]":
            if self._kind(i - 2) == "string" and self._word(i - 3) == "[":
                literal = self._literal(self.tokens[i - 2])
                return (literal.text, i - 3) if literal else None
            if self._kind(i - 2) == "name" and self._word(i - 3) == "[" and self._word(i - 5) == ":" and self._kind(i - 6) == "name":
                return self._word(i - 6), i - 6
            return None
        if self._kind(i - 1) == "name":
            # An annotated name, as in "name: type = value", unless the second word is the telling one.
            typed = self._word(i) != ":" and self._word(i - 2) == ":" and self._kind(i - 3) == "name"
            at = i - 3 if typed and not sensitivity(self._word(i - 1).strip("${}")) else i - 1
            return self._word(at).strip("${}"), at
        return None

    def _value(self, i: int) -> tuple[list[Literal], list[int], int]:
        """Literals and definitions that the expression from token ``i`` on joins, and where it ends.

        It ends at the next sign, so all expressions of a text together are read once.
        """
        literals: list[Literal] = []
        uses: list[int] = []
        depth, open_end = 0, True
        while i < len(self.tokens):
            kind, word, _, _ = self.tokens[i]
            if kind == "sign":
                break
            if kind == "line":
                if not open_end and not depth:
                    break
            elif kind == "string":
                literal = self._literal(self.tokens[i])
                if literal:
                    literals.append(literal)
                    for names in _INSIDE.findall(literal.text):
                        self._use(next(x for x in names if x), uses)
                open_end = False
            elif kind == "name":
                if self._word(i + 1) == "(":
                    called = re.split(r"\W+", word)[-1].lower()
                    if called not in WRAPPERS:
                        break
                else:
                    self._use(word.strip("${}"), uses)
                open_end = False
            elif word == "(":
                depth += 1
            elif word == ")" and depth:
                depth -= 1
            elif word in "+.\\&":
                open_end = True
            else:
                break
            i += 1
        return literals, uses, i

    def _use(self, name: str, uses: list[int]) -> None:
        if name in self.latest:
            uses.append(self.latest[name])

    def _bare(self, i: int, target: int) -> Literal | None:
        """A value without quotes: the rest of a line that its name begins."""
        end = self.tokens[i][3]
        if not _OPENS.fullmatch(self.text, self._floor, self.tokens[target][2]):
            return None
        stop = self.text.find("\n", end)
        rest = self.text[end : stop if stop >= 0 else len(self.text)]
        bearer = _BEARER.search(rest.strip())
        if bearer and rest.strip().startswith(bearer.group()):
            at = end + rest.index(bearer.group(1))
            return Literal(bearer.group(1), at, at + len(bearer.group(1)))
        match = _BARE.match(rest)
        return Literal(match.group(1), end + match.start(1), end + match.end(1)) if match else None

    def _define(self, name: str, literals: list[Literal], uses: list[int]) -> None:
        self.latest[name] = len(self.found)
        self.found.append(Definition(name, literals, uses))

    def definitions(self) -> list[Definition]:
        line_had_sign = False
        named: tuple[str, int] | None = None
        for i, (kind, word, _, end) in enumerate(self.tokens):
            if kind == "line":
                line_had_sign = False
                self._floor = end
                continue
            if kind == "name" and self._word(i + 1) == "(":
                self._looked_up(i)
            if kind != "sign" or word not in _ASSIGNS:
                continue
            target = self._target(i)
            if target is None:
                line_had_sign = True
                continue
            name, at = target
            literals, uses, _ = self._value(i + 1)
            if word in ("+=", ".="):
                self._use(name, uses)
            if not literals and not uses and not line_had_sign:
                bare = self._bare(i, at)
                literals = [bare] if bare else []
            line_had_sign = True
            # A name and its value as two pairs: name="x" value="y".
            last = re.split(r"\W+", name)[-1].lower()
            if last in ("value", "content", "default") and named and named[1] == len(self.found):
                name = named[0]
            self._define(name, literals, uses)
            named = (literals[0].text, len(self.found)) if last in ("name", "key", "id") and len(literals) == 1 else None
        return self.found

    def _looked_up(self, i: int) -> None:
        """Calls with a name and a value, as in getenv("NAME", "value")."""
        if re.split(r"\W+", self._word(i))[-1].lower() not in LOOKUPS:
            return
        if self._kind(i + 2) == "string" and self._word(i + 3) == ",":
            key = self._literal(self.tokens[i + 2])
            literals, uses, _ = self._value(i + 4)
            if key and (literals or uses):
                self._define(key.text, literals, uses)


class Finding(NamedTuple):
    start: int
    end: int
    target: str
    score: float


def secrets(text: str, least: float = 0.5) -> list[Finding]:
    """Literals that a sensitive name holds, directly or over other names, by rising start.

    The score of a definition is its name's sensitivity times its value's plausibility; what a
    definition uses takes on its score. Each definition uses earlier ones only, so one pass from the
    last to the first is enough.
    """
    if not STEMS.search(text):
        return []
    found = Lexer(text).definitions()
    seen: list[Evidence] = []
    for d in found:
        own = "".join(x.text for x in d.literals)
        seen.append(joined([evidence(own), *(seen[u] for u in d.uses)]))
    scores = [(sensitivity(d.name) * plausibility(e) if sensitivity(d.name) else 0.0, d.name) for d, e in zip(found, seen, strict=True)]
    spans: list[Finding] = []
    for k in range(len(found) - 1, -1, -1):
        score, target = scores[k]
        for u in found[k].uses:
            scores[u] = max(scores[u], (score, target))
        if score >= least:
            spans += [Finding(x.start, x.end, target, score) for x in found[k].literals if candidate(x)]
    for match in _ELEMENT.finditer(text):
        spans += _plain(match.group(1), Literal(match.group(2), *match.span(2)), least)
    for match in _USERINFO.finditer(text):
        spans += _plain("password", Literal(match.group(1), *match.span(1)), least)
    return apart(sorted(spans))


def _plain(name: str, literal: Literal, least: float) -> list[Finding]:
    score = sensitivity(name) and sensitivity(name) * plausibility(evidence(literal.text))
    return [Finding(literal.start, literal.end, name, score)] if score >= least and candidate(literal) else []


def apart(spans: list[Finding]) -> list[Finding]:
    """Sorted spans without those that begin inside an earlier one."""
    kept: list[Finding] = []
    for s in spans:
        if not kept or s.start >= kept[-1].end:
            kept.append(s)
    return kept
