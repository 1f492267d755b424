"""Plain Python answers that the operators' results are compared with."""

import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def shingles(text, width=4):
    found = words((text or "").translate(UPPER))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + width]) for i in range(max(1, len(found) - width + 1)))


def jaccard_components(rows, width=4, threshold=85):
    """{position: (n_shingles, component_id)} for (doc_id, text) rows."""
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    index = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            index[x].append(i)
    common = Counter()
    for owners in index.values():
        common.update(combinations(owners, 2))
    for (a, b), n in common.items():
        if 100 * n >= threshold * (len(sets[a]) + len(sets[b]) - n):
            parent[root(a)] = root(b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return [(doc_id, len(sets[i]), least.get(root(i))) for i, (doc_id, _) in enumerate(rows)]


def quality_counts(text):
    text = text or ""
    found = words(text)
    repeats, seen = set(), defaultdict(list)
    for i in range(len(found) - 4):
        seen[tuple(found[i : i + 5])].append(i)
    for places in seen.values():
        if len(places) > 1:
            for p in places:
                repeats.update(range(p, p + 5))
    lines, earlier, dup = text.split("\n"), set(), 0
    for line in lines:
        if words(line):
            dup += line in earlier
            earlier.add(line)
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), dup, len(repeats)


def targets(sizes, weights=(3, 1, 2), share=1.5, repeats=2):
    """{source: target} by resharing what is over until no target is above its stop."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    goal, fixed = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in fixed]
        if not rest:
            return fixed
        level = (goal - sum(fixed.values())) / sum(weight[s] for s in rest)
        over = [s for s in rest if weight[s] * level > repeats * sizes[s]]
        if not over:
            return fixed | {s: weight[s] * level for s in rest}
        fixed |= {s: float(repeats * sizes[s]) for s in over}


def crc32(text):
    return zlib.crc32((text or "").encode())


def license_base(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
    hits = []
    for phrase, label in (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")):
        wanted = phrase.split()
        hits += [(i, label) for i in range(len(found) - len(wanted) + 1) if found[i : i + len(wanted)] == wanted]
    places = [i for i, _ in hits]
    return len(found), len(hits), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in hits}))


def license_labels(text, templates, threshold):
    """Labels and best containment over all pairs of a line and a template."""
    split = lambda t: set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(UPPER)))
    out = [(label, len(split(t) & split(line)) / len(split(t))) for line in (text or "").split("\n") for label, t in templates]
    out = [(label, share) for label, share in out if share >= threshold]
    return {label for label, _ in out}, max((share for _, share in out), default=0.0)


def host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return host.translate(UPPER), path


def url_rule(host, path, rules):
    fits = [r for r, _ in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
    return max(fits, key=len, default=None)


def nearest(rows, queries, k):
    """[(query_id, rank, vec_id, score)] by comparing every query with every row."""
    import math

    import numpy as np

    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for q in queries:
        for own in {i: v for i, v in good if i == q}.values():
            scores = {}
            for i, v in good:
                if i != q and len(v) == len(own):
                    scores[i] = max(scores.get(i, -2), float(v @ own / math.sqrt(v @ v) / math.sqrt(own @ own)))
            ranked = sorted(scores.items(), key=lambda x: (-round(x[1], 12), x[0]))[:k]
            out += [(q, n, i, s) for n, (i, s) in enumerate(ranked, 1)]
    return out


def damaged_conversations(rows):
    """{conv_id: its rows (turn, role, text) after damage, by turn} for (conv_id, turn, role, text) rows."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        out[conv]
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1])) for c, v in out.items()}


def conversation_faults(rows):
    """The fault of each row of a conversation, or None."""
    seen, out = set(), []
    for _, role, text in rows:
        kept = "".join(c for c in text if c not in " \t\n\x0b\x0c\r")
        out.append("blank" if not kept else "duplicate" if (role, text) in seen else "truncated" if kept[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def repaired_conversation(rows):
    """(cost, audit, the repaired `role:text` lines) by trying every edit at every row, from the last row back."""
    faults = conversation_faults(rows)
    n = len(rows)
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}
    best = {}
    for i in range(n, -1, -1):
        here = {}
        for state in after:
            found = [(0, "", ())] if i == n and state in ("", "a") else []
            if i < n:
                _, role, text = rows[i]
                extra = faults[i] == "truncated"
                if best[i + 1][state] is not None:
                    cost, audit, lines = best[i + 1][state]
                    found.append((cost + 3, "D" + audit, lines))
                if faults[i] not in ("blank", "duplicate"):
                    own = role[:1]
                    if (own == after[state] or (state == "" and own == "s")) and best[i + 1][own] is not None:
                        cost, audit, lines = best[i + 1][own]
                        found.append((cost + extra, "K" + audit, (f"{role}:{text}", *lines)))
                    new = after[state]
                    if best[i + 1][new] is not None:
                        cost, audit, lines = best[i + 1][new]
                        found.append((cost + extra + 2, "R" + audit, (f"{names[new]}:{text}", *lines)))
            here[state] = min(found, key=lambda f: f[:2], default=None)
        for _ in range(4):
            for state in after:
                onward = here[after[state]]
                if onward is not None:
                    longer = (onward[0] + 2, "I" + onward[1], (f"{names[after[state]]}:", *onward[2]))
                    here[state] = longer if here[state] is None else min(here[state], longer, key=lambda f: f[:2])
        best[i] = here
    return best[0][""]


def conversation_report(rows):
    """The rows of the registered query for (conv_id, turn, role, text) rows."""
    import hashlib

    out = []
    for conv, kept in damaged_conversations(rows).items():
        turns = [t for t, _, _ in kept if t is not None]
        faults = Counter(conversation_faults(kept))
        initials = [r[:1] for _, r, _ in kept]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        cost, audit, lines = repaired_conversation(kept)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def collocations(rows, least=100, longest=5, top=2000):
    """[(lang, rank, phrase, a, l, r, n, score)] for (text, lang) rows, by counting every phrase."""
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(UPPER)):
            found = re.findall("[^ \t]+", piece)
            total[lang] += len(found)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(found[i : i + k]) for i in range(len(found) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = set()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                inside.update(p[i : i + k] for i in range(len(p) - k + 1) if a >= f[p[i : i + k]])
        scored = []
        for p, a in candidates.items():
            if p not in inside:
                score, _, l, r = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -score))
    return out
