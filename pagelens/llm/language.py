"""Language identification with a bidirectional gated recurrent network over the bytes of words.

The network reads a word's bytes in both directions and labels every position with a probability for
each language; a document's probability is the mean over the positions of its distinct words. Words
are the network's segments, so each distinct word of a batch is read once, however often it occurs.
"""

from pyspark.sql import Window, functions as F

from pagelens.llm.encoding import documents, parts_of, sums, text_slices, with_types

UNDETERMINED = "und"
LONGEST = 24  # Bytes read at a time; the rest of a longer word is a segment of its own.


def words_of(texts):
    """Distinct lower-case runs of letters of an Arrow array of texts, their places and each text's first place."""
    import pyarrow.compute as pc
    return parts_of(pc.utf8_lower(pc.replace_substring_regex(texts, r"\PL+", " ")), " ")


def segments(word):
    raw = word.encode()
    return [raw[i:i + LONGEST] for i in range(0, len(raw), LONGEST)]


# --------------------------------------------------------------------- network
def new_parameters(hidden, languages, rng):
    def scaled(*shape):
        return (rng.standard_normal(shape) * 0.2).astype("float32")
    return {"input0": scaled(256, 3 * hidden), "input1": scaled(256, 3 * hidden),
            "state0": scaled(hidden, 3 * hidden), "state1": scaled(hidden, 3 * hidden),
            "output": scaled(2 * hidden, languages), "bias": scaled(languages) * 0}


def forward_direction(inputs, state, x, order, keep):
    """States of one direction over words of equal length, rows of ``x``; ``keep`` also returns what training needs."""
    import numpy as np
    hidden = len(state)
    h = np.zeros((len(x), hidden), "float32")
    states, tape = np.empty((x.shape[1], len(x), hidden), "float32"), {}
    for t in order:
        a, b = inputs[x[:, t]], h @ state
        gates = 0.5 + 0.5 * np.tanh(0.5 * (a[:, :2 * hidden] + b[:, :2 * hidden]))
        update, reset = gates[:, :hidden], gates[:, hidden:]
        new = np.tanh(a[:, 2 * hidden:] + reset * b[:, 2 * hidden:])
        if keep:
            tape[t] = h, update, reset, new, b[:, 2 * hidden:]
        h = new + update * (h - new)
        states[t] = h
    return states, tape


def orders(length):
    return range(length), range(length - 1, -1, -1)


def probabilities(parameters, x, keep=False):
    """Probability of each language at each position: length x words x languages."""
    import numpy as np
    both = [forward_direction(parameters[f"input{d}"], parameters[f"state{d}"], x, order, keep)
            for d, order in enumerate(orders(x.shape[1]))]
    states = np.concatenate([states for states, _ in both], axis=2)
    logits = states @ parameters["output"] + parameters["bias"]
    logits -= logits.max(axis=2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=2, keepdims=True)
    return (p, states, [tape for _, tape in both]) if keep else p


def gradients(parameters, x, y):
    """Backpropagation through time of the mean cross entropy over all positions."""
    import numpy as np
    p, states, tapes = probabilities(parameters, x, True)
    hidden = len(parameters["state0"])
    p[:, np.arange(len(y)), y] -= 1
    p /= p.shape[0] * p.shape[1]
    flat = states.reshape(-1, 2 * hidden)
    found = {"output": flat.T @ p.reshape(len(flat), -1), "bias": p.sum(axis=(0, 1))}
    d_states = p @ parameters["output"].T
    for d, order in enumerate(orders(x.shape[1])):
        state, tape = parameters[f"state{d}"], tapes[d]
        d_input, d_state = np.zeros_like(parameters[f"input{d}"]), np.zeros_like(state)
        dh = np.zeros((len(x), hidden), "float32")
        for t in reversed(order):
            dh += d_states[t][:, d * hidden:(d + 1) * hidden]
            before, update, reset, new, inner = tape[t]
            d_new = dh * (1 - update) * (1 - new * new)
            d_update = dh * (before - new) * update * (1 - update)
            d_reset = d_new * inner * reset * (1 - reset)
            d_inner = np.concatenate([d_update, d_reset, d_new * reset], axis=1)
            d_state += before.T @ d_inner
            np.add.at(d_input, x[:, t], np.concatenate([d_update, d_reset, d_new], axis=1))
            dh = dh * update + d_inner @ state.T
        found[f"input{d}"], found[f"state{d}"] = d_input, d_state
    return found


def fit(words, languages, hidden=12, steps=1500, batch=512, rate=0.01, seed=1):
    """Train on (bytes, language index) pairs with Adam; every batch holds words of one length."""
    import numpy as np
    rng = np.random.default_rng(seed)
    parameters = new_parameters(hidden, languages, rng)
    by_length = {}
    for word, language in words:
        by_length.setdefault(len(word), []).append((word, language))
    lengths = sorted(by_length)
    sizes = np.array([n * len(by_length[n]) for n in lengths], "float64")
    tables = {n: (np.frombuffer(b"".join(w for w, _ in rows), "uint8").reshape(-1, n), np.array([y for _, y in rows]))
              for n, rows in by_length.items()}
    first, second = ({k: np.zeros_like(v) for k, v in parameters.items()} for _ in range(2))
    for step in range(1, steps + 1 if words else 1):
        x, y = tables[lengths[rng.choice(len(lengths), p=sizes / sizes.sum())]]
        rows = rng.integers(0, len(y), batch)
        now = rate * min(1, 2 * (1 - step / (steps + 1)))
        for name, g in gradients(parameters, x[rows], y[rows]).items():
            first[name] += 0.1 * (g - first[name])
            second[name] += 0.01 * (g * g - second[name])
            parameters[name] -= now * (first[name] / (1 - 0.9 ** step)) / (np.sqrt(second[name] / (1 - 0.99 ** step)) + 1e-8)
    return parameters


# ----------------------------------------------------------------------- Spark
def train(labelled, id_column="doc_id", text_column="text", lang_column="lang", documents_per_language=300,
          words_per_document=60, **settings):
    """Train on a bounded sample: per language the ``documents_per_language`` documents with the smallest hash of
    their id, and of each ``words_per_document`` words spread evenly over its whole text.

    Rows without text or language are left out. Returns (languages in order, parameters); without any
    labelled letter the list of languages is empty.
    """
    rows = labelled.select(labelled[id_column].cast("long").alias("doc_id"), labelled[text_column].cast("string").alias("text"),
                           labelled[lang_column].cast("string").alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = rows.select("doc_id", "lang").distinct().withColumn("_n", F.row_number().over(order))
    chosen = chosen.filter(F.col("_n") <= documents_per_language).drop("_n")
    # At most documents_per_language ids for each language.
    sample = rows.join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi").select("lang", "text")

    def pick(batches):
        import pyarrow as pa
        for batch in batches:
            langs, found = [], []
            for keys, texts in text_slices(batch):
                distinct, index, offsets = words_of(texts)
                for lang, first, last in zip(keys.to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                    places = index[first:last][::max(1, (last - first) // words_per_document)]
                    for raw in (s for i in places for s in segments(distinct[i])):
                        langs.append(lang)
                        found.append(raw)
            yield pa.RecordBatch.from_arrays([pa.array(langs, "string"), pa.array(found, "binary")], ["lang", "segment"])

    collected = sorted((r.lang, bytes(r.segment)) for r in sample.mapInArrow(pick, "lang string, segment binary").collect())
    languages = sorted({lang for lang, _ in collected})
    number = {lang: i for i, lang in enumerate(languages)}
    return languages, fit([(raw, number[lang]) for lang, raw in collected], len(languages), **settings)


def score_words(parameters, words):
    """Sums over the positions of each word: probabilities and labels per language, and the number of positions."""
    import numpy as np
    languages = parameters["bias"].shape[0]
    out = np.zeros((len(words), 2 * languages + 1))
    by_length = {}
    for i, word in enumerate(words):
        for raw in segments(word):
            by_length.setdefault(len(raw), []).append((i, raw))
    for n, rows in by_length.items():
        places = np.array([i for i, _ in rows])
        x = np.frombuffer(b"".join(raw for _, raw in rows), "uint8").reshape(-1, n)
        for at in range(0, len(x), 4096):
            p = probabilities(parameters, x[at:at + 4096])
            labels = np.eye(languages)[p.argmax(axis=2)].sum(axis=0)
            block = np.concatenate([p.sum(axis=0, dtype="float64"), labels, np.full((p.shape[1], 1), n)], axis=1)
            np.add.at(out, places[at:at + 4096], block)
    return out


def predict(docs, model, id_column="doc_id", text_column="text", entries=50_000, carried=()):
    """doc_id, lang_pred, score (mean probability over the positions of
    its distinct words, 0 to 1), n_positions (bytes of letters),
    labels (positions labelled with each language, in the model's order).

    Texts that are NULL or have no letter are ``und`` with score 0. Every row is judged on its own text,
    so rows with equal ids keep their own results. ``entries`` bounds the memory of known words. If columns
    are ``carried``, the result also has the text as it was and a struct ``carried`` of them, so that no join
    is needed to find them again.
    """
    languages, parameters = model
    names = ["text", "carried"] if carried else []

    def run(batches):
        import numpy as np
        import pyarrow as pa
        known, width = {}, 2 * len(languages) + 1
        for batch in batches:
            at = 0
            for keys, texts in text_slices(batch, 4 << 20):
                more = [batch.column(1 + i).slice(at, len(keys)) for i in range(len(names))]
                at += len(keys)
                distinct, index, offsets = words_of(texts)
                if len(known) > entries:
                    known.clear()
                new = [w for w in distinct if w and w not in known]
                if languages:
                    known.update(zip(new, score_words(parameters, new)))
                nothing = np.zeros(width)
                table = np.stack([known.get(w, nothing) for w in distinct]) if distinct else np.zeros((0, width))
                values = np.stack([sums(table[index, c], offsets) for c in range(width)], axis=1)
                n = values[:, -1]
                # Each word of a document is pooled once, or a word repeated throughout would outweigh the others.
                size = max(1, len(distinct))
                once = np.unique(np.repeat(np.arange(len(n)), np.diff(offsets)) * size + index)
                bounds = np.searchsorted(once, np.arange(len(n) + 1) * size)
                pooled = np.stack([sums(table[once % size, c], bounds) for c in [*range(len(languages)), width - 1]], axis=1)
                mean = pooled[:, :-1] / np.maximum(pooled[:, -1:], 1)
                best = mean.argmax(axis=1) if languages else np.zeros(len(n), int)
                named = [languages[i] if size else UNDETERMINED for i, size in zip(best, n)]
                score = np.clip(mean.max(axis=1) if languages else n * 0, 0, 1)
                labels = [row.tolist() for row in values[:, len(languages):-1].astype("int64")]
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(named, "string"), pa.array(np.round(score, 4)), pa.array(n.astype("int64")),
                     pa.array(labels, pa.list_(pa.int64())), *more], ["doc_id", "lang_pred", "score", "n_positions", "labels", *names])

    rows = documents(docs, id_column, text_column, carried)
    return rows.mapInArrow(
        run, with_types(rows, "doc_id long, lang_pred string, score double, n_positions long, labels array<long>", *names))
