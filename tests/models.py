"""Sequential models: the rules one row, one page, one result at a time."""


def ingest(pages, pool):
    """pages: [(page, [key, ...])] in order. Returns admitted (page, index) and counts."""
    known, admitted, counts = set(pool), [], {}
    for page, keys in pages:
        added = [i for i, key in enumerate(keys) if key not in known]
        counts[page] = (len(added), len(added), len(keys) - len(added))
        admitted += [(page, i) for i in added]
        known |= set(keys)
    return admitted, counts


def eligible(anonymous):
    return anonymous is not None and (anonymous == "A" or anonymous.startswith("W"))


def sweep(pool):
    """pool: [[id, anonymous, status]]. One cycle, level by level from the top."""
    pool = [list(row) for row in pool]
    dispatched = []
    for level in sorted({r[2] for r in pool if eligible(r[1])}, reverse=True):
        for row in pool:
            if eligible(row[1]) and row[2] == level:
                row[2] += 1
        dispatched += [(r[0], r[2]) for r in pool if eligible(r[1]) and r[2] == level + 1]
    return pool, dispatched


def fold(pool, now, history, outcomes):
    """One outcome after the other, in arrival order.

    pool: {id: (ip, port)}; now: {url: (tm, anonymous)}; history: {id: status};
    outcomes: [(result, url, id, ip, port, anonymous, status, tm)].
    """
    pool, now, history = dict(pool), dict(now), dict(history)
    for result, url, id_, ip, port, anonymous, status, tm in outcomes:
        if result < 1:
            pool = {k: v for k, v in pool.items() if v != (ip, port)}
            history[id_] = status
            now.pop(url, None)
        else:
            now[url] = (tm, anonymous)
    return pool, now, history


def replay(events, known=()):
    """events: [(key, dead)] in order. Returns admitted positions and the members."""
    members, admitted = set(known), []
    for at, (key, dead) in enumerate(events):
        if dead:
            members.discard(key)
        elif key not in members:
            members.add(key)
            admitted.append(at)
    return admitted, members
