"""The operators' results in plain Python, and documents to hold them against."""

import random
import re
from collections import Counter, defaultdict

WHITE = "\x20\x09-\x0d"
WORD = re.compile(f"[^{WHITE}]+")
VOCABULARY = [a + b + c for a in "bdfgklmnprst" for b in "aeiou" for c in ("", "n", "r", "st")]


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def documents(seed=1):
    """(doc_id, text, source): copies, near copies, shared passages, nulls, empty, repeated, very long."""
    rng = random.Random(seed)
    passage = prose(rng, 70)
    texts = [prose(rng, rng.choice((3, 30, 120, 300))) for _ in range(40)]
    base = prose(rng, 150)
    near = []
    for k in range(12):
        words = base.split(" ")
        for _ in range(k % 4):
            words[rng.randrange(len(words))] = rng.choice(VOCABULARY).upper()
        near.append(" ".join(words))
    texts += near + [base, base, base.upper(), base[: len(base) // 2]]
    texts += [prose(rng, 40) + "\n" + passage + "\n" + prose(rng, 40) for _ in range(6)]
    texts += [None, "", " \t\n", "one", "One", "a b c d", "x" * 199, "x" * 450, "ab " * 700, prose(rng, 20_000), "é" * 260]
    texts += ["The first line of this text.\nAnother line that is long enough.\nThe first line of this text."]
    texts += ["another line that is LONG enough.\n\nthe first line of this text!"]
    rows = [(i, t, None if i % 11 == 0 else f"s{i % 4 if i % 3 else 0}") for i, t in enumerate(texts)]
    return rows + [rows[-1], (None, base, "s1"), (None, None, None), (rows[3][0], "another text of a known id", "s1")]


def lowered(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def shingle_set(text, width=5):
    w = WORD.findall(lowered(text))
    if len(w) < width:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1))


def groups(items, linked):
    """Least index of the group of each item; ``linked`` holds pairs of indices."""
    parent = list(range(items))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(items)]


def near_duplicate_groups(texts, percent=80):
    sets = [shingle_set(t) for t in texts]
    links = []
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                links.append((i, j))
    return sets, groups(len(texts), links)


def repeated_bytes(texts, length=200):
    """For each text the bytes left and the number of removed bytes and runs."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[p : p + length] for t in raw for p in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        left = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((left, sum(gone), len(re.findall(b"\1+", bytes(gone)))))
    return out


def quality_counts(text):
    t = text or ""
    w = WORD.findall(t)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in t)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def personal(text):
    """Base spans as kind:start:end."""

    def passes(kind, match):
        digits = re.sub("[^0-9]", "", match)
        if kind == "ip":
            return all(int(x) <= 255 for x in match.split("."))
        if kind == "phone":
            return 8 <= len(digits) <= 15
        if kind == "card":
            twice = [sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))]
            return 16 <= len(digits) <= 19 and sum(twice) % 10 == 0
        return True

    return [
        f"{kind}:{m.start()}:{m.end()}"
        for kind, pattern in BASE.items()
        for m in re.finditer(pattern, text or "")
        if passes(kind, m.group())
    ]


_WRITTEN_OUT = r"[A-Za-z0-9._%+-]+ (?i:at|\(at\)|\[at\]) [A-Za-z0-9-]+(?: (?i:dot|\(dot\)|\[dot\]) [A-Za-z0-9-]+)+"
_DIGITS = r"[(\[]?[0-9]+[)\]]?(?:[./-]?[(\[]?[0-9]+[)\]]?)*"
_NUMERIC = re.compile(rf"({_DIGITS})[\"')\]}}>.,;:!?]*")
_OTHERWISE = {
    "email": re.compile(rf"[^@ ]+@[^@ ]+|{_WRITTEN_OUT}"),
    "ip": re.compile(r"[0-9A-Fa-f]*[.:][0-9A-Fa-f]*[.:][0-9A-Fa-f.:]*"),
    "card": re.compile(r"(?:[^0-9A-Za-z]*[0-9]){12,19}"),
    "phone": re.compile(r"\+?(?:[()\[\]. /-]*[0-9]){7,15}[)\]]?"),
}


def _identifier_like(text):
    """(start, end) of written-out mail addresses, runs of numbers and words with a digit or at sign, in order."""
    words = [m.span() for m in WORD.finditer(text)]
    i = 0
    while i < len(words):
        start, end = words[i]
        mail = re.compile(_WRITTEN_OUT).match(text, start)
        first = _NUMERIC.fullmatch(text[start:end].removeprefix("+"))
        if mail:
            end = mail.end()
        elif first:
            at = end - (len(text[start:end].removeprefix("+")) - len(first[1]))
            while i + 1 < len(words) and at == end and text[end : words[i + 1][0]] == " ":
                more = _NUMERIC.fullmatch(text[words[i + 1][0] : words[i + 1][1]])
                if not more:
                    break
                i, end = i + 1, words[i + 1][1]
                at = words[i][0] + len(more[1])
            end = at
        elif not re.search("[0-9@]", text[start:end]):
            i += 1
            continue
        yield start, end
        while i < len(words) and words[i][0] < end:
            i += 1


def found_personal(texts, sure=0.8, support=5):
    """For each text, the spans beside sure contexts as {(start, end): kinds that are surest}."""
    seen = []  # text, start, end, value, seed, contexts, failed
    for t, text in enumerate(texts):
        text = text or ""
        good, failed = [], []
        for k, kind in enumerate(BASE):
            passed = {x for x in personal(text) if x.startswith(kind)}
            for m in re.finditer(BASE[kind], text):
                digits = len(re.sub("[^0-9]", "", m.group()))
                if f"{kind}:{m.start()}:{m.end()}" in passed:
                    good.append((k, kind, *m.span(), m.group()))
                elif kind != "card" or 16 <= digits <= 19:
                    failed.append((kind, *m.span()))
        found = list(_identifier_like(text))
        for n, (a, b) in enumerate(found):
            before = text[found[n - 1][1] if n else 0 : a]
            after = text[b : found[n + 1][0] if n + 1 < len(found) else len(text)]
            left, right = WORD.findall(before.lower()), re.match(f"[{WHITE}]+([^{WHITE}]+)(?:[{WHITE}]|$)", after.lower())
            contexts = {f"{left[-1]} _"} if left else set()
            contexts |= {f"{left[-2]} {left[-1]} _"} if len(left) > 1 else set()
            contexts |= {f"_ {right[1]}"} if right else set()
            value = text[a:b]
            front = 0 if re.match(r"[(\[][0-9]+[)\]].", value, re.DOTALL) else len(value) - len(value.lstrip("\"'([{<"))
            a, b = a + front, a + len(value.rstrip("\"')]}>.,;:!?"))
            if a >= b:
                continue
            inner = sorted(g for g in good if a <= g[2] < b)
            if not inner and any(g[2] < b and a < g[3] for g in good):
                continue
            misses = {kind for kind, x, y in failed if x < b and a < y}
            seen.append((t, a, b, (inner[0][4] if inner else text[a:b]).lower(), inner[0][1] if inner else None, contexts, misses))
    beside, kinds = defaultdict(set), {}
    for *_, value, seed, contexts, _ in seen:
        for c in contexts:
            beside[c].add(value)
            kinds[c, value] = max(kinds.get((c, value)) or "", seed or "")
    scores = {(v, k): 1.0 for (_, v), k in kinds.items() if k}
    while True:
        patterns = {}
        for c, values in beside.items():
            for kind in BASE:
                mass = sum(scores.get((v, kind), 0.0) for v in values)
                if mass >= support and mass / len(values) >= sure:
                    patterns[c, kind] = mass / len(values)
        then = {(v, k): 1.0 for (_, v), k in kinds.items() if k}
        for (c, kind), score in patterns.items():
            for v in beside[c]:
                if not kinds[c, v]:
                    then[v, kind] = max(then.get((v, kind), 0.0), score)
        if then == scores:
            break
        scores = then
    out = [defaultdict(dict) for _ in texts]
    for t, a, b, value, seed, contexts, misses in seen:
        for (c, kind), score in patterns.items():
            if seed is None and c in contexts and kind not in misses and _OTHERWISE[kind].fullmatch(value):
                out[t][a, b][kind] = max(score, out[t][a, b].get(kind, 0.0))
    return [{span: {k for k, s in by.items() if s > max(by.values()) - 1e-9} for span, by in o.items()} for o in out]


def leaks(texts, items, percent=80):
    """{(text index, item index): best similarity} of windows as long as the item."""
    found = {}
    for j, item in enumerate(items):
        w = WORD.findall((item or "").lower())
        if not w:
            continue
        width = min(5, len(w))
        grams = [tuple(w[k : k + width]) for k in range(len(w) - width + 1)]
        a, known = Counter(grams), set(grams)
        for i, text in enumerate(texts):
            words = WORD.findall((text or "").lower())
            runs = [tuple(words[k : k + width]) for k in range(len(words) - width + 1)]
            if not known & set(runs):
                continue
            for s in range(max(1, len(runs) - len(grams) + 1)):
                b = Counter(runs[s : s + len(grams)])
                both = sum((a & b).values())
                whole = sum(a.values()) + sum(b.values()) - both
                if 100 * both >= percent * whole:
                    found[i, j] = max(found.get((i, j), 0), both / whole)
    return found




def removed_lines(rows, percent=80):
    """{(row index, place)} of lines that a similar line before them makes redundant."""
    places = defaultdict(list)
    for i, (doc_id, text, _) in enumerate(rows):
        for place, line in enumerate((text or "").split("\n")):
            if WORD.search(line):
                places[line].append((doc_id is None, doc_id or 0, i, place))
    lines = list(places)
    sets = [frozenset(x.lower()[k : k + 8] for k in range(max(1, len(x.lower()) - 7))) for x in lines]
    links = [
        (i, j)
        for i in range(len(lines))
        for j in range(i)
        if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    members = defaultdict(list)
    for root, line in zip(groups(len(lines), links), lines, strict=True):
        members[root] += places[line]
    return {(i, place) for m in members.values() for _, _, i, place in sorted(m)[1:]}
