"""A small causal self-attention model over subword ids, in numpy: training and scoring.

One layer with one head and a feed-forward part, over windows of SPAN tokens. Windows overlap: each scores its last STRIDE
tokens, so that every token is scored once, with STRIDE to SPAN - 1 tokens of context before it. The output is a softmax
over classes and one over the members of the class, sqrt(vocabulary) each.
"""

from __future__ import annotations

import numpy as np

VOCABULARY = 1024
SIDE = 32  # classes, and members of each
START, END = VOCABULARY - 2, VOCABULARY - 1
STRIDE = 16
SPAN = 2 * STRIDE - 1
WIDTH = 32
HEAD = 16
HIDDEN = 32

_rows = np.arange(SPAN)[STRIDE - 1 :]
#: 1 where a query at a scored place may look, else 0; exponentials are multiplied by it
SEEN = (np.arange(SPAN)[None, :] <= _rows[:, None]).astype(np.float32)


def initial(seed: int = 11) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)

    def draw(*shape: int, scale: float) -> np.ndarray:
        return (r.standard_normal(shape) * scale).astype(np.float32)

    return {
        "embed": draw(VOCABULARY, WIDTH, scale=0.3),
        "place": draw(SPAN, WIDTH, scale=0.1),
        "query": draw(WIDTH, HEAD, scale=0.25),
        "key": draw(WIDTH, HEAD, scale=0.25),
        "value": draw(WIDTH, HEAD, scale=0.25),
        "join": draw(HEAD, WIDTH, scale=0.25),
        "up": draw(WIDTH, HIDDEN, scale=0.25),
        "up_bias": np.zeros(HIDDEN, np.float32),
        "down": draw(HIDDEN, WIDTH, scale=0.25),
        "out": draw(WIDTH, VOCABULARY, scale=0.1),
        "out_bias": np.zeros(VOCABULARY, np.float32),
        "class": draw(WIDTH, SIDE, scale=0.1),
        "class_bias": np.zeros(SIDE, np.float32),
    }


def packed(p: dict[str, np.ndarray]) -> bytes:
    return b"".join(x.astype(np.float32).tobytes() for x in p.values())


def unpacked(data: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, x in initial().items():
        out[name] = data[at : at + x.size].reshape(x.shape).astype(np.float32)
        at += x.size
    return out


def windows(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs (n, SPAN) and targets (n, STRIDE) of the windows over texts of `sizes` tokens; target -1: none.

    Also where each window's first target lies in `ids`. Every text is preceded by START tokens.
    """
    count = -(-sizes // STRIDE)
    room = (count + 1) * STRIDE
    begin = np.cumsum(room) - room
    first = np.cumsum(sizes) - sizes
    stream = np.full(int(room.sum()), -1, np.int16)
    stream[np.repeat(begin + STRIDE - first, sizes) + np.arange(len(ids))] = ids
    pads = (begin[:, None] + np.arange(STRIDE)).ravel()
    stream[pads] = START
    number = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    at = np.repeat(begin, count) + number * STRIDE
    inputs = stream[at[:, None] + np.arange(SPAN)]
    targets = stream[at[:, None] + STRIDE + np.arange(STRIDE)]
    return np.maximum(inputs, 0), targets, np.repeat(first, count) + number * STRIDE


_ONES = np.ones(SIDE, np.float32)
_SPAN_ONES = np.ones(SPAN, np.float32)


def _limited(z: np.ndarray) -> np.ndarray:
    """In place. Logits of a trained model are small; the limit only keeps sums of exponentials finite."""
    return np.minimum(z, 60, out=z)


class Scorer:
    """Log probabilities of tokens; products of the embeddings with the first weights are looked up."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p = p
        scale = np.float32(HEAD**-0.5)
        self.query = (p["embed"] @ p["query"] * scale, (p["place"] @ p["query"] * scale)[STRIDE - 1 :])
        self.key = (p["embed"] @ p["key"], p["place"] @ p["key"])
        self.value = (p["embed"] @ p["value"], p["place"] @ p["value"])
        self.plain = (p["embed"], p["place"][STRIDE - 1 :])
        # weights of each class's members
        self.members = np.ascontiguousarray(p["out"].reshape(WIDTH, SIDE, SIDE).transpose(1, 0, 2))
        self.member_bias = p["out_bias"].reshape(SIDE, SIDE)

    def hidden(self, inputs: np.ndarray) -> np.ndarray:
        p = self.p
        inputs = inputs.astype(np.intp)
        recent = inputs[:, STRIDE - 1 :]
        q, k, v = (np.take(x, at, axis=0) for x, at in
                   ((self.query[0], recent), (self.key[0], inputs), (self.value[0], inputs)))
        q += self.query[1]
        k += self.key[1]
        v += self.value[1]
        z = np.matmul(q, k.transpose(0, 2, 1))
        np.exp(_limited(z), out=z)
        z *= SEEN
        h = np.matmul(z, v)
        h /= (z @ _SPAN_ONES)[..., None]
        h = h.reshape(-1, HEAD) @ p["join"]
        own = np.take(self.plain[0], recent, axis=0)
        own += self.plain[1]
        h += own.reshape(-1, WIDTH)
        u = h @ p["up"]
        u += p["up_bias"]
        np.maximum(u, 0, out=u)
        h += u @ p["down"]
        return h

    def score(self, inputs: np.ndarray, targets: np.ndarray, batch: int = 256, group: int = 4096) -> np.ndarray:
        """Natural log probability of every target, 0 where there is none.

        Attention runs over `batch` windows at once, the softmax over members over the tokens of `group` windows.
        """
        out = np.zeros(targets.shape, np.float32)
        for a in range(0, len(inputs), group):
            t = targets[a : a + group].ravel().astype(np.int64)
            real = np.flatnonzero(t >= 0)
            hidden = np.concatenate([self.hidden(inputs[b : min(b + batch, a + group)])
                                     for b in range(a, min(a + group, len(inputs)), batch)])
            classes = np.maximum(t, 0) // SIDE
            found = np.empty(len(t), np.float32)
            for b in range(0, len(t), batch * STRIDE):
                z = hidden[b : b + batch * STRIDE] @ self.p["class"]
                z += self.p["class_bias"]
                _limited(z)
                part = found[b : b + batch * STRIDE]
                part[:] = z[np.arange(len(z)), classes[b : b + batch * STRIDE]]
                part -= np.log(np.exp(z, out=z) @ _ONES)
            order = real[np.argsort(classes[real].astype(np.uint8), kind="stable")]
            edges = np.searchsorted(classes[order], np.arange(SIDE + 1))
            for c in range(SIDE):
                mine = order[edges[c] : edges[c + 1]]
                if len(mine):
                    z = np.take(hidden, mine, axis=0) @ self.members[c]
                    z += self.member_bias[c]
                    _limited(z)
                    part = z[np.arange(len(mine)), t[mine] % SIDE]
                    found[mine] += part - np.log(np.exp(z, out=z) @ _ONES)
            flat = out[a : a + group].reshape(-1)
            flat[real] = found[real]
        return out


def _softmax(z: np.ndarray) -> np.ndarray:
    """In place, over the last axis."""
    np.exp(_limited(z), out=z)
    z /= (z @ np.ones(z.shape[-1], z.dtype))[..., None]
    return z


def _sums(rows: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Sums of the rows of each id, (VOCABULARY, columns)."""
    order = np.argsort(ids.astype(np.int16), kind="stable")
    ids = ids[order]
    first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    out = np.zeros((VOCABULARY, rows.shape[1]), rows.dtype)
    out[ids[first]] = np.add.reduceat(np.take(rows, order, axis=0), first, axis=0)
    return out


def gradients(p: dict[str, np.ndarray], inputs: np.ndarray, targets: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean loss of the targets, and its gradients. Members are scored within the class of each target only.

    Keys and values are looked up in products of the embeddings with their weights, and their gradients are added up by
    token and by place before they go through the weights.
    """
    kind = p["embed"].dtype
    scale = kind.type(HEAD**-0.5)
    inputs = inputs.astype(np.intp)
    n = len(inputs)
    late = inputs[:, STRIDE - 1 :].ravel()
    pair = np.concatenate([p["key"], p["value"]], axis=1)
    kv = np.take(p["embed"] @ pair, inputs, axis=0)
    kv += p["place"] @ pair
    k, v = kv[..., :HEAD], kv[..., HEAD:]
    x = np.take(p["embed"], late, axis=0).reshape(n, STRIDE, WIDTH)
    x += p["place"][STRIDE - 1 :]
    x = x.reshape(-1, WIDTH)
    q = (x @ (p["query"] * scale)).reshape(n, STRIDE, HEAD)
    a = np.matmul(q, k.transpose(0, 2, 1))
    np.exp(_limited(a), out=a)
    a *= SEEN
    a /= (a @ np.ones(SPAN, kind))[..., None]
    c = np.matmul(a, v).reshape(-1, HEAD)
    h = c @ p["join"]
    h += x
    r = h @ p["up"]
    r += p["up_bias"]
    np.maximum(r, 0, out=r)
    y = r @ p["down"]
    y += h
    # the targets in the order of their classes
    t = targets.reshape(-1)
    real = np.flatnonzero(t >= 0)
    order = real[np.argsort((t[real] // SIDE).astype(np.uint8), kind="stable")]
    t = t[order].astype(np.intp)
    group, member, rows = t // SIDE, t % SIDE, np.arange(len(t))
    edges = np.searchsorted(group, np.arange(SIDE + 1)).tolist()
    parts = [(s, slice(edges[s], edges[s + 1])) for s in range(SIDE) if edges[s] < edges[s + 1]]
    y = np.take(y, order, axis=0)
    pc = y @ p["class"]
    pc += p["class_bias"]
    pc = _softmax(pc)
    members = np.ascontiguousarray(p["out"].reshape(WIDTH, SIDE, SIDE).transpose(1, 0, 2))
    bias = p["out_bias"].reshape(SIDE, SIDE)
    pm = np.empty((len(t), SIDE), kind)
    for s, mine in parts:
        np.matmul(y[mine], members[s], out=pm[mine])
        pm[mine] += bias[s]
    pm = _softmax(pm)
    weight = kind.type(1 / max(len(t), 1))
    loss = -(np.log(pc[rows, group] + 1e-30) + np.log(pm[rows, member] + 1e-30)).sum() * weight
    pc[rows, group] -= 1
    pm[rows, member] -= 1
    back = pc @ p["class"].T
    d_members, d_bias = np.zeros_like(members), np.zeros_like(bias)
    turned = np.ascontiguousarray(members.transpose(0, 2, 1))
    ones = np.ones(max(len(h), len(t)), kind)
    for s, mine in parts:
        part = pm[mine]
        np.matmul(y[mine].T, part, out=d_members[s])
        np.matmul(ones[: len(part)], part, out=d_bias[s])
        back[mine] += part @ turned[s]
    back *= weight
    g = {
        "class": y.T @ pc * weight,
        "class_bias": ones[: len(t)] @ pc * weight,
        "out": d_members.transpose(1, 0, 2).reshape(WIDTH, VOCABULARY) * weight,
        "out_bias": d_bias.ravel() * weight,
    }
    dy = np.zeros_like(h)
    dy[order] = back
    g["down"] = r.T @ dy
    du = dy @ p["down"].T
    du *= r > 0
    g["up"], g["up_bias"] = h.T @ du, ones[: len(du)] @ du
    dh = du @ p["up"].T
    dh += dy
    g["join"] = c.T @ dh
    dc = (dh @ p["join"].T).reshape(n, STRIDE, HEAD)
    d_kv = np.empty_like(kv)
    np.matmul(a.transpose(0, 2, 1), dc, out=d_kv[..., HEAD:])
    ds = np.matmul(dc, v.transpose(0, 2, 1))
    ds -= ((dc.reshape(-1, HEAD) * c) @ np.ones(HEAD, kind)).reshape(n, STRIDE, 1)
    ds *= a
    np.matmul(ds.transpose(0, 2, 1), q, out=d_kv[..., :HEAD])
    dq = np.matmul(ds, k).reshape(-1, HEAD)
    dq *= scale
    g["query"] = x.T @ dq
    dh += dq @ p["query"].T
    by_id, by_place = _sums(d_kv.reshape(-1, 2 * HEAD), inputs.ravel()), d_kv.sum(0)
    d_pair = p["embed"].T @ by_id + p["place"].T @ by_place
    g["key"], g["value"] = d_pair[:, :HEAD], d_pair[:, HEAD:]
    g["embed"] = by_id @ pair.T + _sums(dh, late)
    g["place"] = by_place @ pair.T
    g["place"][STRIDE - 1 :] += dh.reshape(n, STRIDE, WIDTH).sum(0)
    return float(loss), {name: g[name] for name in p}


class Trainer:
    """Adam over batches of windows; the rate falls to a tenth over `steps`."""

    def __init__(self, p: dict[str, np.ndarray], steps: int, rate: float):
        self.flat = np.frombuffer(packed(p), np.float32).copy()
        self.m, self.v = np.zeros_like(self.flat), np.zeros_like(self.flat)
        self.p, at = {}, 0
        for name, x in p.items():
            self.p[name] = self.flat[at : at + x.size].reshape(x.shape)
            at += x.size
        self.steps, self.rate, self.done = steps, rate, 0

    def step(self, inputs: np.ndarray, targets: np.ndarray) -> float:
        loss, g = gradients(self.p, inputs, targets)
        self.done += 1
        g = np.concatenate([x.ravel() for x in g.values()])
        self.m += np.float32(0.1) * (g - self.m)
        g *= g
        self.v += np.float32(0.01) * (g - self.v)
        now = self.rate * (1 - 0.9 * min(self.done / self.steps, 1)) / (1 - 0.9**self.done)
        root = np.sqrt(self.v)
        root *= np.float32((1 - 0.99**self.done) ** -0.5)
        root += np.float32(1e-6)
        np.divide(self.m, root, out=root)
        root *= np.float32(now)
        self.flat -= root
        return loss


def train(
    p: dict[str, np.ndarray],
    inputs: np.ndarray,
    targets: np.ndarray,
    steps: int,
    rate: float,
    batch: int = 96,
    seed: int = 3,
) -> tuple[dict[str, np.ndarray], list[float]]:
    """Some steps over windows drawn at random."""
    r = np.random.default_rng(seed)
    trainer = Trainer(p, steps, rate)
    losses = []
    for _ in range(steps):
        at = r.integers(0, len(inputs), batch)
        losses.append(trainer.step(inputs[at], targets[at]))
    return trainer.p, losses
