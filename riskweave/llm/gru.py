"""A gated recurrent network with a class-factored softmax, in numpy: windows with carried state, truncated gradients."""

import numpy as np

END = 0  # stands after every text and before the first token of the next, where the state starts anew
F32 = np.float32
LIMIT = 60  # of the size of a logit


class Shape:
    """Units and classes: END, `bands` single units, then `head` words in classes of `side` words each."""

    def __init__(self, bands, head, side, hidden, width):
        self.bands, self.head, self.side, self.hidden = bands, head, side, hidden
        self.first = 1 + bands  # unit and class of the first word
        self.units = self.first + head
        self.classes = self.first + -(-head // side)
        groups = max(self.classes - self.first, 1)
        units = np.arange(self.units)
        self.class_of = np.where(units < self.first, units, self.first + (units - self.first) // side).astype(
            np.int16 if self.units < 1 << 15 else np.int32)
        self.sizes = {"E": (self.units, width), "W": (3, width, hidden), "R": (3, hidden, hidden), "Wc": (hidden, self.classes),
                      "bc": (self.classes,), "Ww": (groups, hidden, side), "bw": (groups, side)}

    def views(self, flat):
        out, at = {}, 0
        for name, size in self.sizes.items():
            n = int(np.prod(size))
            out[name] = flat[at:at + n].reshape(size)
            at += n
        return out

    def length(self):
        return sum(int(np.prod(s)) for s in self.sizes.values())

    def initial(self, class_counts, word_counts, seed=7):
        """Parameters that give every unit its share of the counts, whatever the state."""
        rng = np.random.default_rng(seed)
        flat = np.zeros(self.length(), dtype=F32)
        p = self.views(flat)
        for name, scale in (("E", 0.5), ("W", 0.5), ("R", 1 / np.sqrt(self.hidden)), ("Wc", 0.02), ("Ww", 0.02)):
            p[name][:] = rng.normal(0, scale, self.sizes[name])
        p["bc"][:] = np.log(np.asarray(class_counts, dtype=np.float64) + 0.5)
        p["bc"][:] -= p["bc"].max()
        word = np.full(p["bw"].size, -30.0)
        word[:len(word_counts)] = np.log(np.maximum(word_counts, 1))
        p["bw"][:] = word.reshape(p["bw"].shape)
        p["bw"][:] -= p["bw"].max(axis=1, keepdims=True)
        return flat



def sigmoid(x):
    """The logistic function of twice x, in the place of x."""
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


def steps(p, x, h, keep=None):
    """States after each of the T inputs of x (T, B); `keep` collects what the gradient needs. Gates stand apart: z, r, n."""
    out = np.empty((len(x), *h.shape), dtype=F32)
    live = (x != END).astype(h.dtype)
    halves = np.array([0.5, 0.5, 1], dtype=F32)[:, None, None]  # gates take half of their sums, which is exact
    given, R, ends = np.matmul(p["E"][x][:, None], p["W"] * halves), p["R"] * halves, (live == 0).any(axis=1).tolist()
    for t in range(len(x)):
        if ends[t]:
            h = h * live[t][:, None]
        g, a = given[t], np.matmul(h, R)
        gate = g[:2]
        gate += a[:2]
        z, r = sigmoid(gate)
        n = r * a[2]
        n += g[2]
        np.tanh(n, out=n)
        np.subtract(h, n, out=out[t])
        out[t] *= z
        out[t] += n
        if keep is not None:
            keep.append((h, a[2], z, r, n))
        h = out[t]
    return out


def softmax(x):
    """(x within +-LIMIT, in its place, its exponentials, their sums by row): no row can overflow or come to nothing."""
    np.clip(x, -LIMIT, LIMIT, out=x)
    e = np.exp(x)
    return x, e, e @ np.ones(x.shape[1], dtype=x.dtype)


def outputs(p, shape, states, y, gradient=False):
    """Natural logarithms of the probabilities of y; with `gradient` also those of states and parameters."""
    classes = shape.class_of[y]
    logits = states @ p["Wc"]
    logits += p["bc"]
    logits, chance, total = softmax(logits)
    at = np.arange(len(y))
    found = logits[at, classes].astype(np.float64) - np.log(total)
    order = np.argsort(classes, kind="stable")
    order = order[np.searchsorted(classes[order], shape.first):]
    bounds = np.searchsorted(classes[order], np.arange(shape.first, shape.classes + 1)).tolist()
    ranges = [(g, a, b) for g, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])) if b > a]
    chosen, logits = states[order], np.empty((len(order), shape.side), dtype=F32)
    for g, a, b in ranges:
        np.matmul(chosen[a:b], p["Ww"][g], out=logits[a:b])
        logits[a:b] += p["bw"][g]
    inner, share, whole = softmax(logits)
    place, inside = (y[order] - shape.first) % shape.side, np.arange(len(order))
    found[order] += inner[inside, place] - np.log(whole)
    if not gradient:
        return found
    grads = {}
    chance /= total[:, None]
    d = chance
    d[at, classes] -= 1
    grads["Wc"], grads["bc"] = states.T @ d, d.sum(axis=0)
    back = d @ p["Wc"].T
    share /= whole[:, None]
    di = share
    di[inside, place] -= 1
    grads["Ww"], grads["bw"] = np.zeros_like(p["Ww"]), np.zeros_like(p["bw"])
    inner_back = np.empty_like(chosen)
    for g, a, b in ranges:
        grads["Ww"][g], grads["bw"][g] = chosen[a:b].T @ di[a:b], di[a:b].sum(axis=0)
        np.matmul(di[a:b], p["Ww"][g].T, out=inner_back[a:b])
    back[order] += inner_back
    return found, back, grads


def window_gradient(p, shape, x, y, h):
    """(log likelihood, gradients of its negative mean, last states) of a window; gradients end at its first step."""
    T, B = x.shape
    H, keep = shape.hidden, []
    states = steps(p, x, h, keep)
    found, back, grads = outputs(p, shape, states.reshape(T * B, H), y.reshape(-1), gradient=True)
    back = back.reshape(T, B, H)
    dg = np.empty((T, 3, B, H), dtype=F32)
    R, dR, after = p["R"].transpose(0, 2, 1), np.zeros_like(p["R"]), np.zeros((B, H), dtype=F32)
    live = (x != END).astype(F32)
    ends = (live == 0).any(axis=1).tolist()
    for t in range(T - 1, -1, -1):
        before, a_n, z, r, n = keep[t]
        dh = back[t] + after
        pre = dg[t]
        u = 1 - z
        np.multiply(dh * u, 1 - n * n, out=pre[2])
        u *= z
        u *= before - n
        np.multiply(u, dh, out=pre[0])
        v = r * (1 - r)
        v *= a_n
        np.multiply(v, pre[2], out=pre[1])
        da = pre.copy()
        da[2] *= r
        dR += np.matmul(before.T, da)
        after = dh * z
        after += np.matmul(da, R).sum(axis=0)
        if ends[t]:
            after *= live[t][:, None]
    flat = x.reshape(-1)
    grads["R"], grads["E"] = dR, np.zeros_like(p["E"])
    grads["W"] = np.matmul(p["E"][x].transpose(0, 2, 1)[:, None], dg).sum(axis=0)
    into = np.matmul(dg, p["W"].transpose(0, 2, 1)).sum(axis=1).reshape(T * B, -1)
    order = np.argsort(flat.astype(np.int16 if shape.units < 1 << 15 else np.int32), kind="stable")
    units, first = np.unique(flat[order], return_index=True)
    grads["E"][units] = np.add.reduceat(into[order], first, axis=0)
    for g in grads.values():
        g /= T * B
    return float(found.sum()), grads, states[-1]


class Adam:
    def __init__(self, n, rate, b1=0.9, b2=0.99):
        self.m, self.v, self.t = np.zeros(n, dtype=F32), np.zeros(n, dtype=F32), 0
        self.rate, self.b1, self.b2 = rate, b1, b2

    def step(self, flat, g):
        self.t += 1
        self.m += (1 - self.b1) * (g - self.m)
        np.multiply(g, g, out=g)
        g -= self.v
        g *= 1 - self.b2
        self.v += g
        scale = self.rate * np.sqrt(1 - self.b2 ** self.t) / (1 - self.b1 ** self.t)
        np.sqrt(self.v, out=g)
        g += 1e-7
        np.divide(self.m, g, out=g)
        g *= scale
        flat -= g


def train(flat, shape, stream, rate, window=32, most=256, updates=100):
    """Parameters after one pass over a stream of units (texts, each with its END), cut into lanes of equal length.

    There are `most` lanes, or fewer so that a short stream makes about `updates` windows.
    """
    flat = flat.copy()
    lanes = int(np.clip(len(stream) // (window * updates), 8, most))
    length = len(stream) // lanes
    if not length:
        return flat
    y = stream[:lanes * length].reshape(lanes, length).T
    x = np.concatenate((np.array([END], dtype=stream.dtype), stream[:-1]))[:lanes * length].reshape(lanes, length).T
    p, h, adam = shape.views(flat), np.zeros((lanes, shape.hidden), dtype=F32), Adam(len(flat), rate)
    for t in range(0, length, window):
        _, grads, h = window_gradient(p, shape, x[t:t + window], y[t:t + window], h)
        adam.step(flat, np.concatenate([grads[n].reshape(-1) for n in shape.sizes]))
    return flat


def score(flat, shape, texts, window=32, most=512):
    """Natural logarithm of the probability of every text, a list of arrays of units with their END.

    Whole texts are dealt to lanes, the longest first to the shortest lane; a lane carries its state from window to window.
    """
    p, sizes = shape.views(flat), np.array([len(t) for t in texts])
    lanes = min(most, len(texts))
    load, lists = np.zeros(lanes, dtype=np.int64), [[] for _ in range(lanes)]
    for i in np.argsort(-sizes, kind="stable").tolist():
        lane = int(load.argmin())
        lists[lane].append(i)
        load[lane] += sizes[i]
    order = np.argsort(-load, kind="stable")  # lanes that end first come last, so the ones at work are in front
    load, lists = load[order], [lists[i] for i in order.tolist()]
    y = np.zeros((lanes, int(load[0])), dtype=np.int32)
    for row, own in zip(y, lists):
        row[:sum(len(texts[i]) for i in own)] = np.concatenate([texts[i] for i in own])
    logp, h = np.zeros(y.shape), np.zeros((lanes, shape.hidden), dtype=F32)
    last = np.full(lanes, END, dtype=np.int32)
    for t in range(0, y.shape[1], window):
        busy = int(np.searchsorted(-load, -t, side="left"))  # lanes longer than t
        part = y[:busy, t:t + window].T
        x = np.concatenate((last[None, :busy], part[:-1]))
        states = steps(p, x, h[:busy])
        logp[:busy, t:t + window] = outputs(p, shape, states.reshape(-1, shape.hidden), part.reshape(-1)).reshape(part.shape).T
        h[:busy], last[:busy] = states[-1], part[-1]
    total = np.zeros(len(texts))
    for row, own in zip(logp, lists):
        ends = np.cumsum([len(texts[i]) for i in own])
        total[own] = np.add.reduceat(row[:ends[-1]], np.concatenate(([0], ends[:-1])))  # without the rest of the lane
    return total
