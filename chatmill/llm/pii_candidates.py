"""Personal data in a text: base spans, candidate spans and their features (task side).

Base spans follow fixed patterns and checks. Candidates are proposed more
freely, overlapping: parts of a run of digits that the base check refused as a
whole, numbers without a plus, addresses that are written around the @. Offsets
are code points.

Examples to learn from are made out of base spans: the span itself, and the
span with its surroundings or its writing changed so that a rule no longer
finds it, are right; parts, joined and damaged copies are not.
"""

from __future__ import annotations

import random
import re
import zlib

KINDS = ("email", "ip", "card", "phone")
# Fixed patterns of the contract, possessive where that changes no match.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_ANY = re.compile(r"[0-9]").search
# Candidates.
_DOTTED = re.compile(r"(?<![0-9.])[0-9]++(?: ?\. ?[0-9]++){3,}+")
_GROUPS = re.compile(r"[0-9]++")
_DIGIT_RUN = re.compile(r"[0-9]++(?:[ .-]{1,2}[0-9]++)*+")
_CALL = re.compile(r"(?:\+|(?<![0-9A-Za-z])(?:00|\()|(?<![0-9A-Za-z+(]))[0-9][ ().0-9-]*[0-9]")
_SPELT = re.compile(r"[A-Za-z0-9._%+-]{1,64}(?: ?[\[({] ?(?:at|AT) ?[\])}] ?| (?:at|AT) | ?@ ?)[A-Za-z0-9-]{1,64}(?:(?: ?[\[({]? ?(?:dot|DOT) ?[\])}]? ?| ?\. ?)[A-Za-z0-9-]{2,64}){1,4}")
_HINTS = {"email": re.compile(r"mail|contact|kontakt|correo|courriel", re.I), "ip": re.compile(r"\bip\b|host|server|addr|login", re.I),
          "card": re.compile(r"card|visa|karte|carte|tarjeta|pay|zahl", re.I), "phone": re.compile(r"tel|phone|call|mobil|fax|ruf", re.I)}
#: Characters of context on either side, and groups of digits that a part may have.
CONTEXT, MAX_GROUPS = 24, 8
FEATURES = ("digits", "groups", "shortest", "longest", "luhn", "distinct", "octets", "plus", "brackets", "separators", "kinds_of_separators",
            "letters", "upper", "dots", "at", "length", "before", "after", "run_before", "run_after", "digits_around", "letters_around", "hint", "last_group", "first_group")


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _octets(s: str) -> bool:
    return all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in s.split("."))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the contract's base spans, ascending."""
    out, at = [], 0
    while (i := text.find("@", at)) >= 0:
        start = i
        while start > at and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, i + 1) if start < i else None
        if m:
            out.append((start, 0, m.end()))
        at = m.end() if m else i + 1
    if not _ANY(text):
        return out
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if _octets(m.group())]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := digits_of(m.group())) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(digits_of(m.group())) <= 15]
    return sorted(out)


def _parts(m: re.Match) -> list[tuple[int, int]]:
    """The groups of digits of a match."""
    return [(m.start() + g.start(), m.start() + g.end()) for g in _GROUPS.finditer(m.group())]


def candidates(text: str) -> set[tuple[int, int, int]]:
    """(start, kind, end) of everything that may be personal data."""
    out = set()
    if "@" in text or "at" in text or "AT" in text:
        if "@" in text or " dot " in text or " DOT " in text or any(x in text for x in ("at]", "at)", "at}", "AT]", "AT)", "AT}")):
            out.update((m.start(), 0, m.end()) for m in _SPELT.finditer(text))
    if not _ANY(text):
        return out
    for m in _DOTTED.finditer(text):
        groups = _parts(m)
        out.update((groups[i][0], 1, groups[i + 3][1]) for i in range(len(groups) - 3))
    for m in _DIGIT_RUN.finditer(text):
        groups = _parts(m)
        for i, (start, _) in enumerate(groups):
            n = 0
            for begin, end in groups[i:i + MAX_GROUPS]:
                n += end - begin
                if n > 19:
                    break
                if n >= 12:
                    out.add((start, 2, end))
    for m in _CALL.finditer(text):
        groups = _parts(m)
        begins = [m.start()] + [s - (text[s - 1] == "(") for s, _ in groups[1:]]
        for i, start in enumerate(begins):
            n = 0
            for begin, end in groups[i:i + MAX_GROUPS]:
                n += end - begin
                if n > 15:
                    break
                if n >= 9:
                    out.add((start, 3, end))
    return out


def apart(spans: set[tuple[int, int, int]], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans that touch no base span, ascending."""
    out, at, reach = [], 0, -1
    for span in sorted(spans):
        while at < len(base) and base[at][0] <= span[0]:
            reach = max(reach, base[at][2])
            at += 1
        if reach <= span[0] and (at == len(base) or base[at][0] >= span[2]):
            out.append(span)
    return out


def _class(c: str) -> int:
    if not c:
        return 0
    return 1 if c.isspace() else 2 if c.isdigit() else 3 if c.isalpha() else 4 if c in ".,;:!?" else 5 if c in "-+/" else 6 if c in "\"'()[]" else 7


def features(text: str, start: int, kind: int, end: int) -> list[float]:
    """Format and context of a candidate, in the order of FEATURES."""
    s = text[start:end]
    d = digits_of(s)
    groups = [len(g) for g in re.findall(r"[0-9]+", s)] or [0]
    seps = re.findall(r"[^0-9A-Za-z]+", s)
    left, right = text[max(0, start - CONTEXT):start], text[end:end + CONTEXT]
    near = left + right
    return [len(d), len(groups), min(groups), max(groups), luhn(d) if d else 0, len(set(d)),
            len(groups) == 4 and all(int(g) <= 255 for g in re.findall(r"[0-9]+", s) if len(g) < 9) and max(groups) < 9,
            "+" in s, s.count("("), len(seps), len(set(seps)), sum(map(str.isalpha, s)), sum(map(str.isupper, s)), s.count("."), s.count("@"), end - start,
            _class(left[-1:]), _class(right[:1]), bool(re.search(r"[0-9][ .()-]{0,2}\Z|\+\Z", left)), bool(re.match(r"[ .()-]{0,2}[0-9]", right)),
            len(digits_of(near)), sum(map(str.isalpha, near)), bool(_HINTS[KINDS[kind]].search(near)), groups[-1], groups[0]]


def _variants(text: str, start: int, kind: int, end: int, rng: random.Random) -> list[tuple[str, int, int, bool]]:
    """(text, start, end, right) of changed copies of a base span in its surroundings."""
    left, s, right = text[max(0, start - 2 * CONTEXT):start], text[start:end], text[end:end + 2 * CONTEXT]
    at = len(left)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    put = lambda new, ok: (left + new + right, at, at + len(new), ok)
    out = [put(s, True)]
    if kind:
        more = number(rng.randint(1, 3)) if kind != 3 else number(rng.choice([3, 12, 16]))
        out.append((left + s + " " + more + right, at, at + len(s), True))                  # a number stands behind it
        out.append((left + more + " " + s + right, at + len(more) + 1, at + len(more) + 1 + len(s), True))
    if kind == 0:
        name, _, domain = s.partition("@")
        out += [put(f"{name}{a}{domain.replace('.', d)}", True) for a, d in (("[at]", "."), (" (at) ", " (dot) "), (" at ", " dot "), (" @ ", "."))]
        out += [put(f"{name[-3:]} at {domain.split('.')[0]} . {domain.split('.')[-1]}", False), put(f"{name} @ {domain.split('.')[0]} . The", False)]
    elif kind == 1:
        out += [put(s.replace(".", " . "), True), put(f"{rng.randint(256, 999)}.{s.split('.', 1)[1]}", False)]
        out += [(left + s + "." + number(1) + right, at, at + len(s), False), (left + "v" + s + right, at + 1, at + 1 + len(s), False)]
        small = ".".join(number(1) for _ in range(4))
        out.append((left + "version " + small + right, at + 8, at + 8 + len(small), False))
    elif kind == 2:
        i = rng.choice([i for i, c in enumerate(s) if c.isdigit()])
        out.append(put(s[:i] + str((int(s[i]) + rng.randint(1, 9)) % 10) + s[i + 1:], False))
        d = digits_of(s)
        out.append(put(".".join(d[j:j + 4] for j in range(0, len(d), 4)), True))
        wrong = put(number(len(d)), False)
        out.append(wrong[:3] + (luhn(digits_of(wrong[0][wrong[1]:wrong[2]])),))
        out.append((left + "a" + s + "f" + right, at + 1, at + 1 + len(s), False))
    else:
        bare = s.lstrip("+")
        out += [put("00" + bare, True)]
        if "(" in s:
            inner = s[s.index("("):]
            out.append(put(inner, True) if 9 <= len(digits_of(inner)) <= 15 else put(s, True))
        d = digits_of(s)
        out += [put(d, False), put(f"{number(4)}-{number(2)}-{number(2)} {number(2)}.{number(2)}", False), put(".".join(number(3) for _ in range(4)), False)]
    return out


def _alone(text: str, start: int, kind: int, end: int) -> bool:
    return (0, kind, end - start) in base_spans(text[start:end])


def examples(text: str, folds: int) -> list[tuple[int, int, int, list[float]]]:
    """(kind, fold, label, features) made out of a text's base spans, and of its
    candidates that touch none. Of these, what would be a base span if it stood
    alone is neither right nor wrong: it may be what the base has lost."""
    base, free = base_spans(text), candidates(text)
    out = []
    if not base and not free:
        return out
    fold = zlib.crc32(text.encode("utf-8", "surrogatepass"))
    rng = random.Random(fold)
    fold %= folds
    for start, kind, end in base:
        for changed, begin, stop, ok in _variants(text, start, kind, end, rng):
            out.append((kind, fold, int(ok), features(changed, begin, kind, stop)))
            for b, k, e in candidates(changed):
                # another cut of the same place; a part that would do alone may be what the base has taken more with
                if k == kind and (b, e) != (begin, stop) and b < stop and e > begin and not (b >= begin and e <= stop and _alone(changed, b, k, e)):
                    out.append((k, fold, 0, features(changed, b, k, e)))
    out += [(k, fold, 0, features(text, b, k, e)) for b, k, e in apart(free, base) if not _alone(text, b, k, e)]
    return out
