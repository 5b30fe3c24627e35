"""Plain Python versions of what the operators return."""

import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    found = words(text)
    windows = [tuple(found[i : i + 8]) for i in range(len(found) - 7)]
    counts = Counter(windows)
    covered = {i + j for i, window in enumerate(windows) if counts[window] > 1 for j in range(8)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    n = len(found)
    return (
        n,
        sum(map(len, found)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(covered),
        n < 20 or 100 * len(covered) > 30 * n,
    )


def shingle_set(text, size=4):
    found = words((text or "").translate(LOWER))
    if len(found) < size:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)}


def near_duplicates(rows, size=4):
    """(id, text) pairs -> list of (id, n_shingles, component_id), in order."""
    sets = [shingle_set(text, size) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, own in enumerate(sets):
        shared = Counter(j for shingle in own for j in holders[shingle])
        for j, n in shared.items():
            if 100 * n >= 80 * (len(own) + len(sets[j]) - n):
                parent[root(i)] = root(j)
        for shingle in own:
            holders[shingle].append(i)
    smallest = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            smallest[root(i)] = min(smallest.get(root(i), key), key)
    return [(key, len(own), smallest.get(root(i)) if own else key) for i, ((key, _), own) in enumerate(zip(rows, sets))]


LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def licenses(text):
    """n_words, n_base, first_word, last_word, base_labels."""
    found = LICENSE_WORD.findall((text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        own = [i for i in range(len(found)) if found[i : i + len(parts)] == parts]
        places += own
        labels |= {label} if own else set()
    return len(found), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def targets(sizes, max_copies=3):
    """Target of each source by the water level."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = [s for s in sizes if s not in full]
        level = (total - sum(max_copies * sizes[s] for s in full)) / max(1, sum(weight[s] for s in rest))
        now = {s for s in sizes if max_copies * sizes[s] <= level * weight[s]}
        if now <= full:
            return {s: min(max_copies * sizes[s], level * weight[s]) for s in sizes}
        full |= now


def line_dedup(rows, least=20, documents=3):
    """(id, text) pairs -> list of (id, n_lines, n_dropped, kept text), in order; a null id is the smallest."""

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)

    holders = defaultdict(list)
    for at, (own_id, text) in enumerate(rows):
        for own in {key(line) for line in (text or "").split("\n")}:
            holders[own].append(own_id)
    found = []
    for own_id, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            held = holders[key(line)]
            largest = max((i for i in held if i is not None), default=None)
            if len(key(line)) < least or len(held) < documents or own_id == largest:
                kept.append(line)
        found.append((own_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return found


def spelling_counts(rows, letters=6, least=5):
    counts = Counter()
    for own_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(LOWER)
            checksum = zlib.crc32(f"{'' if own_id is None else own_id}:{word}".encode())
            if checksum % 199 == 0:
                at = checksum % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    return {word: n for word, n in counts.items() if len(word) >= letters and n >= least}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def spelling_variants(counts, ratio=5):
    """word -> (form, root, n, n_near, form_n); all pairs of words are compared."""
    by_length = defaultdict(list)
    for word in counts:
        by_length[len(word)].append(word)
    form, found = {}, {}
    for word, n in counts.items():
        near = [v for k in (-1, 0, 1) for v in by_length[len(word) + k] if one_apart(word, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= ratio * n:
            form[word] = best
        found[word] = len(near)
    for word, n_near in found.items():
        root = word
        while root in form:
            root = form[root]
        own = form.get(word)
        found[word] = (own, root, counts[word], n_near, counts.get(own))
    return found


def alignment(sides):
    """One pair of token-byte lists with ids, [(id, bytes)] for A and B, for each row (None: no tokens) -> rows
    (n_a, n_b, n_groups, n_links, n_best, count_sum, groups)."""
    linked = []
    for pair in sides:
        links, spans = [], []
        for tokens in pair or ([], []):
            at, own = 0, []
            for i, piece in tokens:
                own.append((at, at + len(piece), i))
                at += len(piece)
            spans.append(own)
        for a0, a1, a in spans[0]:
            links += [(a, b) for b0, b1, b in spans[1] if max(a0, b0) < min(a1, b1)]
        ends = sorted({a1 for _, a1, _ in spans[0]} & {b1 for _, b1, _ in spans[1]})
        groups, start = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for x, y, i in own if start <= x and y <= end) for own in spans))
            start = end
        linked.append((len(spans[0]), len(spans[1]), groups, links))
    counts = Counter(pair for *_, links in linked for pair in set(links))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return [
        (n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links), ";".join(groups))
        for n_a, n_b, groups, links in linked
    ]
