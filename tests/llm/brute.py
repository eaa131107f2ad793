"""Plain-Python versions of the operators that compare documents."""

import re
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0D]+")


class Groups:
    """Union of linked things; the smallest stands for a group."""

    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def link(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.parent[b] = a


def ascii_lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def shingle_set(t, n):
    w = WORD.findall(ascii_lower(t or ""))
    return {tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()


def near(rows, n, percent=80):
    """doc_id -> (set size, component) of rows (doc_id, text)."""
    groups = Groups()
    sets = [(i, shingle_set(t, n)) for i, t in rows]
    for k, (i, a) in enumerate(sets):
        groups.find(i)
        for j, b in sets[:k]:
            both = len(a & b)
            if both and 100 * both >= percent * (len(a) + len(b) - both):
                groups.link(i, j)
    return [(i, len(a), groups.find(i)) for i, a in sets]


def statistics(t):
    w = WORD.findall(t or "")
    windows = Counter(zip(w, w[1:], w[2:]))
    repeated = {k + o for k in range(len(w) - 2) if windows[tuple(w[k:k + 3])] > 1 for o in range(3)}
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(repeated))


def normalised(line):
    return re.sub("[\x20\x09-\x0D]+", " ", line.lower()).strip(" ")


def line_rules(rows, rules):
    """For each row (doc_id, text, source): (statistics, base_failed, kept, cleaned text)."""
    holders, texts, first = defaultdict(set), defaultdict(set), {}
    for i, t, s in rows:
        texts[s].add(t)
        for line in (t or "").split("\n"):
            if WORD.search(line):
                key = s, normalised(line)
                holders[key].add(t)
                if i is not None:
                    first[key] = min(first.get(key, i), i)
    above = {k for k, h in holders.items() if len(h) > rules.min_docs and len(h) > rules.max_share * len(texts[k[0]])}
    out = []
    for i, t, s in rows:
        stats = statistics(t)
        failed = stats[0] < rules.min_words or 100 * stats[4] > rules.max_repeat_percent * stats[0]
        total = lost = 0
        staying = []
        for line in (t or "").split("\n"):
            gone = False
            if WORD.search(line):
                key = s, normalised(line)
                total += len(key[1])
                gone = key in above and first.get(key) != i
                lost += len(key[1]) * gone
            if not gone:
                staying.append(line)
        out.append((stats, failed, not failed and lost <= rules.max_removed * total, "\n".join(staying)))
    return out


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def duplicate_lines(rows, least, edits):
    """(doc_id, text) -> numbers of the lines to drop, for rows with ids."""
    at = defaultdict(list)
    for i, t in sorted(set(rows)):
        for n, line in enumerate(t.split("\n")):
            line = line.strip(" \t\x0b\x0c\r")
            if len(line) >= least:
                at[line].append((i, t, n))
    groups = Groups()
    lines = sorted(at, key=len)
    for k, a in enumerate(lines):
        groups.find(a)
        for b in lines[k + 1:]:
            if len(b) - len(a) > edits:
                break
            if distance(a, b) <= edits:
                groups.link(a, b)
    classes = defaultdict(list)
    for line in lines:
        classes[groups.find(line)] += [(p, line) for p in at[line]]
    dropped, near_count = defaultdict(list), Counter()
    for places in classes.values():
        (_, kept), *later = sorted(places, key=lambda x: (x[0][0], x[0][2]))
        for (i, t, n), line in later:
            dropped[i, t].append(n)
            near_count[i, t] += line != kept
    return {k: (sorted(v), near_count[k]) for k, v in dropped.items()}
