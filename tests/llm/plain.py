"""Plain versions of the training-data operators, by the letter of their definitions."""

import collections
import hashlib
import itertools
import re
import struct

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    return [find(i) for i in range(n)]


def shingles(text):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def alike(sets):
    """Pairs of sets that are 80 % alike."""
    return [
        (a, b)
        for a, b in itertools.combinations(range(len(sets)), 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]


def near_copies(rows):
    """(doc_id, shingles, component) of (doc_id, text) rows."""
    sets = [shingles(t) for _, t in rows]
    root = roots(len(rows), alike(sets))
    least = {}
    for r, (d, _) in zip(root, rows):
        least[r] = min(least.get(r, d), d)
    return sorted((d, len(s), least[r]) for (d, _), s, r in zip(rows, sets, root))


def repeats(rows, length=200):
    texts = [(t or "").encode() for _, t in rows]
    seen = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (d, _), t in zip(rows, texts):
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(t), sum(gone), spans, sha(bytes(b for b, g in zip(t, gone) if not g))))
    return sorted(out)


def measures(text):
    w, text = words(text), text or ""
    three = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    inside = {j for i in range(len(w) - 2) if three[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [line for line in text.split("\n") if words(line)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 * (x > 9) for x in doubled) % 10 == 0


def personal(text):
    out = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")),
                "card": lambda: 13 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]()
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def redacted(text):
    at, parts = 0, []
    for kind, a, b in sorted(personal(text), key=lambda s: (s[1], s[2])):
        if a >= at:
            parts += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join(parts) + text[at:] if parts else text


def encoded(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    decoded = tokenizer.decode(ids, skip_special_tokens=False)
    return len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(decoded.encode())
