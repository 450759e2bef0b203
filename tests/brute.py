"""The ranked and full-text methods in plain Python, one query and one document at a time."""

import math
import re
import string

from pagelode.functions import porter2
from pagelode.functions.text import FULLTEXT_STOP_WORDS, STOP_WORDS

DELIMITERS = " \t\n\r\f"


def tokens(text):
    out, word = [], ""
    for ch in text:
        if ch in DELIMITERS:
            if word:
                out.append(word)
            word = ""
        else:
            word += ch
    return out + [word] if word else out


def analyse(text):
    """term -> positions, and the field length."""
    found = {}
    toks = tokens(text.lower())
    for i, tok in enumerate(toks):
        tok = tok.strip(string.punctuation).strip("".join(map(chr, range(33)))).lower()
        if re.fullmatch("[a-zA-Z0-9]+", tok) and tok not in STOP_WORDS:
            found.setdefault(porter2.stem(tok), []).append(i)
    return found, len(toks)


def analyse_fulltext(text):
    found, length = {}, 0
    for i, word in enumerate(re.findall(r"\w+(?:['.’]\w+)*", text.lower())):
        if word not in FULLTEXT_STOP_WORDS:
            found.setdefault(word, []).append(i)
            length += 1
    return found, length


def split_query(query):
    keyword, mark, category = query.partition("category:")
    if mark:
        keyword, category = keyword.strip(), category.strip()
    return keyword.lower(), category.lower()


def words_of(text):
    return [w.strip() for w in text.split(" ") if w.strip()]


class Engine:
    def __init__(self, corpus):
        self.docs = {
            d: [analyse(t), analyse(c), analyse(" ".join(k))] for d, t, c, k in corpus
        }
        self.ft = {
            d: [analyse_fulltext(t), analyse_fulltext(c), analyse_fulltext("|".join(k))] for d, t, c, k in corpus
        }

    def field(self, f, terms):
        n = len(self.docs)
        avg = sum(doc[f][1] for doc in self.docs.values()) / n
        boosts = (2, 1.2000000476837158, 1.0499999523162842, 1, 0.5) if f == 1 else (20, 10, 5, 1, 1)
        out = {}
        for d, doc in self.docs.items():
            found, length = doc[f]
            scores = {}
            for t in set(terms):
                if t not in found:
                    continue
                df = sum(t in other[f][0] for other in self.docs.values())
                k = 1.2 * (0.25 + 0.75 * length / avg)
                tf, qf = len(found[t]), terms.count(t)
                scores[t] = (
                    math.log((n - df + 0.5) / (df + 0.5)) + math.log(2.2 * tf / (k + tf)) + math.log(101 * qf / (100 + qf))
                )
            if not scores:
                continue
            factor = boosts[3]
            if len(scores) == len(set(terms)):
                ordered = all(
                    any(p + 1 in found[b] for p in found[a]) for a, b in zip(terms, terms[1:])
                )
                factor = (boosts[0] if length == len(terms) else boosts[1]) if ordered else boosts[2]
            out[d] = sum(scores.values()) * factor * boosts[4]
        return out

    def search(self, query):
        keyword, category = split_query(query)
        stems = lambda text: [porter2.stem(w) for w in words_of(text) if w not in STOP_WORDS]
        title, content = self.field(0, stems(keyword)), self.field(1, stems(keyword))
        hits = {d: title[d] + content[d] for d in title if d in content}
        if category:
            third = self.field(2, stems(category))
            hits = {d: s + third[d] for d, s in hits.items() if d in third}
        return hits

    def ft_field(self, f, words):
        with_field = [doc[f] for doc in self.ft.values() if doc[f][1]]
        n = len(with_field)
        avg = sum(length for _, length in with_field) / n
        boosts = (2, 1.0499999523162842, 1, 0.5) if f == 1 else (20, 5, 1, 1)
        idf = lambda t: math.log(1 + (n - df(t) + 0.5) / (df(t) + 0.5))
        df = lambda t: sum(t in found for found, _ in with_field)
        out = {}
        for d, doc in self.ft.items():
            found, length = doc[f]
            if not any(w in found for w in words):
                continue
            norm = 1.2 * (0.25 + 0.75 * length / avg)
            single = lambda tf: tf * 2.2 / (tf + norm)
            any_term = sum(idf(w) * single(len(found[w])) for w in words if w in found)
            has_all = all(w in found for w in words)
            starts = (
                [p for p in found[words[0]] if all(p + i in found[w] for i, w in enumerate(words))] if has_all else []
            )
            if starts:
                value = boosts[0] * sum(map(idf, words)) * single(len(starts))
            else:
                value = boosts[2] * any_term
            if has_all:
                value += boosts[1] * any_term
            out[d] = value * boosts[3]
        return out

    def search_fulltext(self, query):
        keyword, category = split_query(query)
        title, content = self.ft_field(0, words_of(keyword)), self.ft_field(1, words_of(keyword))
        hits = {d: title[d] + content[d] for d in title if d in content}
        if category:
            third = self.ft_field(2, words_of(category))
            hits = {d: s + third[d] for d, s in hits.items() if d in third}
        return hits


def pagerank(edges, damping=0.85, tolerance=1e-6, steps=None):
    out = {}
    for s, d in edges:
        out.setdefault(s, []).append(d)
    n = len(out)
    ranks = {v: (1 / n if v in out else 0.0) for e in edges for v in e}
    done = 0
    while True:
        new = {v: (1 - damping) / n for v in ranks}
        for s, targets in out.items():
            for d in targets:
                new[d] += damping * ranks[s] / len(targets)
        moved = max(abs(new[v] - ranks[v]) for v in ranks)
        ranks, done = new, done + 1
        if (steps is None and moved < tolerance) or done == steps:
            return ranks
