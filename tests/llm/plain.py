"""Brute-force versions of the operators, for small tables, and rows to try them on."""

import hashlib
import re
from collections import defaultdict

SEP = r"[^\x20\x09-\x0D]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

ODD_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, digest string, "
              "keep_id long, component string, weight double, bucket int, shard int")


def odd_rows():
    """Nulls, empty and blank texts, a very long text, ties, repeated rows, clashing columns."""
    long_text = " ".join(f"wort{i % 4001}" for i in range(60_000))
    passage = " ".join(f"stelle{i}" for i in range(60))
    near = [f"blatt{i}" for i in range(200)]
    texts = [
        (1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "A"), (6, "a b c"), (7, long_text),
        (8, long_text), (8, long_text), (9, f"vorher {passage} danach"), (10, f"{passage}\nende"),
        (11, " ".join(near)), (12, " ".join(near[:-3] + ["x", "y", "z"])), (13, "  a   b\tc "),
        (14, "a b c"), (15, "ÄÖ ü é 漢字 a"), (16, "q" * 5000), (17, "zeile eins\nzeile eins\n\n\nb"),
        (None, "ohne id"), (None, None), (18, " ".join(["gleich"] * 90)),
    ]
    return [(i, t, None if i == 5 else "de", None if i == 6 else f"s{(i or 0) % 3}", None,
             "x", 7, "y", 0.5, 3, 9) for i, t in texts]


def words(text):
    return re.findall(SEP, text or "")


def shingles(text):
    w = words((text or "").translate(LOWER))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i: i + 5]) for i in range(len(w) - 4)}


def near_components(rows):
    """{doc_id: component}; rows of (doc_id, text), ids unique and not null."""
    sets = {i: shingles(t) for i, t in rows}
    where, parent = defaultdict(list), {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    shared = defaultdict(int)
    for i in sorted(sets):
        for s in sets[i]:
            for j in where[s]:
                shared[j, i] += 1
            where[s].append(i)
    for (i, j), n in shared.items():
        if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
            a, b = root(i), root(j)
            parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in sets}


def without_repeats(rows, window=35):
    """[(doc_id, n_words, n_removed, kept_sha256)] of rows (doc_id, text)."""
    seen = defaultdict(int)
    for _, t in rows:
        w = words(t)
        for i in range(len(w) - window + 1):
            seen[tuple(w[i: i + window])] += 1
    out = []
    for d, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i: i + window])] > 1:
                gone[i: i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def quality_counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)"""
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    at = defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i: i + 3])].append(i)
    covered = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered))


def base_secrets(text):
    """(start, order, end, kind) of the base spans."""
    key = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k)
                   for k in ("password", "passwd", "secret", "token", "api_?key"))
    assign = rf"""({key})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    text = text or ""
    return sorted(
        [(m.start(), 0, m.end(), "assign") for m in re.finditer(assign, text) if len(m[2]) >= 6]
        + [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        + [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


def base_personal(text):
    """(kind, start, end) of the base spans, as the contract orders them."""
    text = text or ""
    out = [("email", *m.span()) for m in re.finditer(
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()][::-1]
        total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits))
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def best_fit(lengths, sequence):
    """Number of sequences of best-fit decreasing, one piece after the other."""
    import bisect

    rooms, opened = [], 0
    for x in sorted(lengths, reverse=True):
        i = bisect.bisect_left(rooms, x)
        room = sequence if i == len(rooms) else rooms.pop(i)
        opened += room == sequence
        if room > x:
            bisect.insort(rooms, room - x)
    return opened
