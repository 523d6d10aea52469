"""A gated recurrent language model with a class-factored softmax, in numpy."""

from __future__ import annotations

import numpy as np

F32 = np.float32


PLACES = 512  # places whose logits are worked on at a time, few enough for a core's cache
SAFE = 60.0  # exp of logits between -SAFE and SAFE needs no shift


def _with_one(out: np.ndarray) -> np.ndarray:
    """The states ``out`` (places x hidden) with a 1 after each, which a bias is multiplied by."""
    ones = np.ones((len(out), out.shape[1] + 1), out.dtype)
    ones[:, :-1] = out
    return ones


def _with_bias(w: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, bool]:
    """Weights and bias as one matrix (members x hidden + 1), and whether a logit can be beyond SAFE.

    States lie between -1 and 1, so the sum of a member's absolute weights bounds its logit.
    """
    wb = np.concatenate([w.T, b[:, None]], axis=1)
    return wb, not np.abs(wb).sum(1).max() < SAFE


def _exps(x: np.ndarray, shift: bool) -> np.ndarray:
    """In place exp(x), or exp(x - max) with ``shift``, of logits (members x places); returns the sums over members.

    Members lie along the first axis, so that maxima and sums run over whole rows of places.
    """
    if shift:
        x -= x.max(0)
    np.exp(x, out=x)
    return x.sum(0)


def _log_prob(wb: np.ndarray, shift: bool, out: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log softmax, at member ``at`` of each place, of the logits of ``out`` (places x hidden + 1)."""
    lp = np.empty(len(out), out.dtype)
    for lo in range(0, len(out), PLACES):
        part = slice(lo, lo + PLACES)
        x = wb @ out[part].T
        if shift:
            x -= x.max(0)
        chosen = x[at[part], np.arange(x.shape[1])]
        lp[part] = chosen - np.log(_exps(x, False))
    return lp


def _errors(wb: np.ndarray, shift: bool, out: np.ndarray, at: np.ndarray, scale: np.ndarray):
    """Gradients of the places' negative log softmax at ``at``, times ``scale``, by ``wb`` and by ``out``."""
    by_wb, by_out = np.zeros_like(wb), np.empty((len(out), wb.shape[1] - 1), out.dtype)
    w = np.ascontiguousarray(wb[:, :-1])
    for lo in range(0, len(out), PLACES):
        part = slice(lo, lo + PLACES)
        x = wb @ out[part].T
        total = _exps(x, shift)
        x[at[part], np.arange(x.shape[1])] -= total
        # What is left is (softmax - one-hot) * total.
        share = (scale[part] / total)[:, None]
        by_wb += x @ (out[part] * share)
        np.matmul(x.T, w, out=by_out[part])
        by_out[part] *= share
    return by_wb, by_out


class Gru:
    """One GRU layer over token ids; words are predicted as class, then member of the class.

    Classes below ``listed`` hold ``width`` listed words each (id = class *
    width + member); a later class is a single id, ``listed * width`` onwards,
    and stands for the unlisted words that fall into it. The state starts from
    zero at each text's first token.
    """

    NAMES = ["inp", "rec", "bias", "cls", "cls_b", "mem", "mem_b"]

    def __init__(self, class_log: np.ndarray, member_log: np.ndarray, hidden: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        listed, width = member_log.shape
        n_classes, h = len(class_log), hidden
        n_ids = listed * width + n_classes - listed
        self.p = {"inp": rng.normal(0, 0.1, (n_ids, 3 * h)), "rec": rng.normal(0, 0.5 / np.sqrt(h), (h, 3 * h)),
                  "bias": np.concatenate([np.full(h, 1.0), np.zeros(2 * h)]),
                  "cls": rng.normal(0, 0.05, (h, n_classes)), "cls_b": class_log,
                  "mem": rng.normal(0, 0.05, (listed, h, width)), "mem_b": member_log}
        self.p = {k: np.ascontiguousarray(v, F32) for k, v in self.p.items()}
        self.h, self.listed, self.width = h, listed, width
        self.moments = None

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in self.NAMES])

    def load(self, flat: np.ndarray) -> Gru:
        self.p = self._views(np.array(flat, F32))
        return self

    def _views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        """The parameters' shapes as views of one array."""
        out, at = {}, 0
        for k in self.NAMES:
            out[k] = flat[at:at + self.p[k].size].reshape(self.p[k].shape)
            at += self.p[k].size
        return out

    def classes(self, ids: np.ndarray) -> np.ndarray:
        top = self.listed * self.width
        return np.where(ids < top, ids // self.width, ids - top + self.listed)

    def gates(self) -> tuple[np.ndarray, np.ndarray]:
        """What ``run`` multiplies with, a matrix for each of the gates z and r and the new state.

        Those of z and r are negative, that of the new state is doubled: sigmoid(x) is 1 / (1 + exp(-x)),
        tanh(x) is 1 - 2 / (1 + exp(2x)).
        """
        p, h = self.p, self.h
        inp = np.ascontiguousarray((p["inp"] + p["bias"]).reshape(-1, 3, h).swapaxes(0, 1))
        rec = np.ascontiguousarray(p["rec"].reshape(h, 3, h).swapaxes(0, 1))
        for x in (inp, rec):
            x[:2] *= F32(-1)
            x[2] *= F32(2)
        return inp, rec

    @np.errstate(over="ignore")  # an infinite exp makes a gate of 0 and a state of 1
    def run(self, ids: np.ndarray, first: np.ndarray, state: np.ndarray, keep: bool = False, gates=None):
        """States that predict each of ``ids`` (steps x lanes), and the state to carry on.

        With ``keep`` also z and r, the new states and r * state of each step. Every array of a step
        is contiguous.
        """
        inp, rec = self.gates() if gates is None else gates
        (steps, lanes), h, kind = ids.shape, self.h, rec.dtype
        outs = np.empty((steps + 1, lanes, h), kind)
        outs[0] = state
        kept = steps if keep else 1
        gate, new, read = (np.empty((kept, *s, lanes, h), kind) for s in ((2,), (), ()))
        x = np.empty((3, lanes, h), kind)
        fresh = first.any(1)
        for t in range(steps):
            # ``state`` has read everything up to the token before ids[t]; a new text starts from zero.
            state, k = outs[t], t if keep else 0
            if fresh[t]:
                state *= (F32(1) - first[t])[:, None]
            inp.take(ids[t], 1, out=x, mode="clip")
            zr, c, rs = gate[k], new[k], read[k]
            np.matmul(state, rec[:2], out=zr)
            zr += x[:2]
            np.exp(zr, out=zr)
            zr += F32(1)
            np.divide(F32(1), zr, out=zr)
            np.multiply(zr[1], state, out=rs)
            np.matmul(rs, rec[2], out=c)
            c += x[2]
            np.exp(c, out=c)
            c += F32(1)
            np.divide(F32(2), c, out=c)
            np.subtract(F32(1), c, out=c)
            after = np.subtract(state, c, out=outs[t + 1])
            after *= zr[0]
            after += c
        return outs[:steps], outs[steps], (gate, new, read)

    def _by_id(self, ids: np.ndarray):
        """Order of ``ids``, which is also that of their classes, and where each listed class starts."""
        small = len(self.p["inp"]) <= np.iinfo(np.int16).max  # short keys are sorted by radix
        order = np.argsort(ids.astype(np.int16) if small else ids, kind="stable")
        return order, np.searchsorted(ids[order], np.arange(self.listed + 1) * self.width)

    def log_probs(self, outs: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Natural log probability of each id (of its class only, for a class of unlisted words)."""
        p = self.p
        out, ids = _with_one(outs.reshape(-1, self.h)), ids.ravel()
        lp = _log_prob(*_with_bias(p["cls"], p["cls_b"]), out, self.classes(ids))
        order, cuts = self._by_id(ids)
        listed = order[:cuts[-1]]
        sorted_out, member = out.take(listed, 0), ids[listed] % self.width
        for c in range(self.listed):  # one product a class
            at = slice(cuts[c], cuts[c + 1])
            if cuts[c] < cuts[c + 1]:
                lp[listed[at]] += _log_prob(*_with_bias(p["mem"][c], p["mem_b"][c]), sorted_out[at], member[at])
        return lp

    def train(self, ids: np.ndarray, first: np.ndarray, live: np.ndarray, window: int, rate: float) -> None:
        """One pass of truncated backpropagation (``ids``: steps x lanes), with Adam steps.

        The last window may be shorter; places where ``live`` is 0 teach nothing.
        Adam's moments go on from the call before.
        """
        w = self.flat()
        self.p = self._views(w)
        m, v, n = self.moments or (np.zeros_like(w), np.zeros_like(w), 0)
        g, step = np.zeros_like(w), np.empty_like(w)
        grads = self._views(g)
        state = np.zeros((ids.shape[1], self.h), F32)
        for lo in range(0, len(ids), window):
            part = slice(lo, lo + window)
            g[:] = 0
            _, state = self._window(ids[part], first[part], state, live[part], grads)
            n += 1
            a = F32(rate * np.sqrt(1 - 0.99 ** n) / (1 - 0.9 ** n))
            np.clip(g, -1, 1, out=g)
            m *= F32(0.9)
            m += np.multiply(g, F32(0.1), out=step)
            v *= F32(0.99)
            g *= g
            v += np.multiply(g, F32(0.01), out=g)
            np.sqrt(v, out=step)
            step += F32(1e-6)
            np.divide(m, step, out=step)
            step *= a
            w -= step
        self.moments = m, v, n

    def _window(self, ids, first, state, live=None, grads=None):
        """Gradients of one window's summed negative log probability over its lanes, and the state after it."""
        p, h = self.p, self.h
        outs, after, (gate, new, read) = self.run(ids, first, state, keep=True)
        steps, lanes = ids.shape
        kind, flat = outs.dtype, ids.ravel()
        out = _with_one(outs.reshape(-1, h))
        scale = np.full(len(flat), 1.0 / lanes, F32)
        if live is not None:
            scale *= live.ravel()
        grads = {k: np.zeros_like(x) for k, x in p.items()} if grads is None else grads
        by_wb, d_out = _errors(*_with_bias(p["cls"], p["cls_b"]), out, self.classes(flat), scale)
        grads["cls"][:], grads["cls_b"][:] = by_wb[:, :h].T, by_wb[:, h]
        order, cuts = self._by_id(flat)
        listed = order[:cuts[-1]]
        sorted_out, sorted_scale, member = out.take(listed, 0), scale[listed], flat[listed] % self.width
        back = np.empty((len(listed), h), kind)
        for c in range(self.listed):
            at = slice(cuts[c], cuts[c + 1])
            if cuts[c] < cuts[c + 1]:
                by_wb, back[at] = _errors(*_with_bias(p["mem"][c], p["mem_b"][c]), sorted_out[at], member[at],
                                          sorted_scale[at])
                grads["mem"][c], grads["mem_b"][c] = by_wb[:, :h].T, by_wb[:, h]
        d_out[listed] += back
        d_out = d_out.reshape(steps, lanes, h)
        dx = np.empty((3, steps, lanes, h), kind)
        d_state, kept, rest, reset = (np.zeros((lanes, h), kind) for _ in range(4))
        through = np.empty((2, lanes, h), kind)
        back_rec = np.ascontiguousarray(p["rec"].reshape(h, 3, h).transpose(1, 2, 0))
        fresh = first.any(1)
        for t in range(steps - 1, -1, -1):
            s, (z, r), c = outs[t], gate[t], new[t]
            dz, dr, dc = dx[:, t]
            np.multiply(d_state, z, out=kept)
            np.subtract(d_state, kept, out=rest)
            d_state, kept = kept, d_state
            np.multiply(c, c, out=dc)
            np.subtract(F32(1), dc, out=dc)
            dc *= rest
            np.matmul(dc, back_rec[2], out=reset)
            reset *= r
            np.subtract(s, c, out=dz)
            dz *= rest
            dz *= z
            np.subtract(F32(1), r, out=dr)
            dr *= s
            dr *= reset
            d_state += reset
            np.matmul(dx[:2, t], back_rec[:2], out=through)
            d_state += through[0]
            d_state += through[1]
            d_state += d_out[t]
            if fresh[t]:
                d_state *= (F32(1) - first[t])[:, None]
        flat_dx = dx.reshape(3, -1, h)
        for k, x in enumerate((out, out, _with_one(read.reshape(-1, h)))):
            by_rec = x.T @ flat_dx[k]
            grads["rec"][:, k * h:(k + 1) * h], grads["bias"][k * h:(k + 1) * h] = by_rec[:h], by_rec[h]
        at = np.flatnonzero(np.r_[True, np.diff(flat[order]) != 0])
        # Two numbers at a time, as a complex one: sums of short runs cost by the number of their columns.
        pairs = flat_dx.take(order, 1).view(np.result_type(kind, np.complex64))
        for k, x in enumerate(pairs):
            grads["inp"][flat[order[at]], k * h:(k + 1) * h] = np.add.reduceat(x, at, axis=0).view(kind)
        return grads, after


def lanes_of(lengths: np.ndarray, lanes: int) -> tuple[np.ndarray, np.ndarray]:
    """(lane, offset) of each text: longest first onto the shortest lane, one text after the other."""
    import heapq
    heap = [(0, i) for i in range(lanes)]
    lane, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        used, at = heapq.heappop(heap)
        lane[i], offset[i] = at, used
        heapq.heappush(heap, (used + int(lengths[i]), at))
    return lane, offset


def laid_out(lengths: np.ndarray, lanes: int):
    """Texts one after the other in lanes, the lanes end to end, the longest lane first.

    Returns each token's place in that order, and each lane's start and length.
    """
    lane, offset = lanes_of(lengths, lanes)
    used = np.bincount(lane, lengths, lanes).astype(np.int64)
    order = np.argsort(-used, kind="stable")
    starts = np.empty(lanes, np.int64)
    starts[order] = np.cumsum(used[order]) - used[order]
    ahead = np.cumsum(lengths) - lengths
    place = np.arange(lengths.sum()) + np.repeat(starts[lane] + offset - ahead, lengths)
    return place, starts[order], used[order]


def in_stream(ids: np.ndarray, lengths: np.ndarray, lanes: int, least: int):
    """All texts end to end, cut into ``lanes`` equal runs, and the marks where a state starts anew.

    Runs have ``least`` tokens or more, so few tokens make fewer lanes. The last
    lanes are padded; the third grid is 1 at the tokens and 0 at the padding.
    """
    lanes = max(1, min(lanes, len(ids) // least))
    steps = -(-len(ids) // lanes)
    grid, first, live = np.zeros(steps * lanes, ids.dtype), np.zeros(steps * lanes, F32), np.zeros(steps * lanes, F32)
    grid[:len(ids)], live[:len(ids)] = ids, 1
    first[(np.cumsum(lengths) - lengths)[lengths > 0]] = 1
    grid, first, live = (np.ascontiguousarray(x.reshape(lanes, steps).T) for x in (grid, first, live))
    first[:1] = 1
    return grid, first, live
