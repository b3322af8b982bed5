"""Chat transcripts as training windows under a budget of tokens, each assistant turn trained on once."""

from pyspark.sql import functions as F

BEGIN, END = "<|im_start|>", "<|im_end|>"
WINDOW = ("conv_id long, window int, text string, n_repeated int, "
          "turns array<struct<role_start:int,role_stop:int,start:int,stop:int>>, loss array<struct<start:int,stop:int>>, tokens long")


def escaped(text):
    """No control string can stand in the result: a backslash goes before each bar that follows '<' and backslashes."""
    import re
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescaped(text):
    import re
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escaped_role(role):
    return escaped(role).replace("%", "%25").replace("\n", "%0A")


def unescaped_role(role):
    return unescaped(role.replace("%0A", "\n").replace("%25", "%"))


def turn_text(role, text):
    return f"{BEGIN}{escaped_role(role)}\n{escaped(text)}{END}\n"


class Windows:
    """Windows of one conversation, fed turn by turn.

    Prefix sums of the turns' tokens decide: a window takes the system turn (the first turn, if its role
    is system), then the last turns before it that fit into ``history`` tokens, then new turns as long as
    the sum stays within ``budget``. History makes room for a new turn: it is shortened from its oldest
    turn on. A turn that is too long even alone gets a window of its own, over the budget. Kept in memory:
    the system turn, the history and the open window.
    """

    def __init__(self, conv, budget, history, count):
        self.conv, self.budget, self.history, self.count = conv, budget, history, count
        self.system, self.before, self.new = [], [], []  # Turns with the prefix sum at their end.
        self.total, self.number = 0, 0

    def size(self, turns):
        return turns[-1][3] - turns[0][3] + turns[0][2] if turns else 0

    def add(self, role, text):
        tokens = self.count(turn_text(role, text))
        self.total += tokens
        turn = (role, text, tokens, self.total)
        done = None
        if self.new and self.size(self.system if self.number else []) + self.size(self.before) + self.size(self.new) + tokens > self.budget:
            done = self.close()
        self.new.append(turn)
        while self.before and self.size(self.system) + self.size(self.before) + self.size(self.new) > self.budget:
            self.before.pop(0)
        return done

    def close(self):
        repeated = ([] if not self.number else self.system) + self.before
        row = window_row(self.conv, self.number, repeated, self.new)
        seen = self.before + self.new
        if not self.number and self.new[0][0] == "system":
            self.system = self.new[:1]
            seen = seen[1:]
        first = len(seen)
        while first and self.size(seen[first - 1:]) <= self.history:
            first -= 1
        self.before, self.new = seen[first:], []
        self.number += 1
        return row


def window_row(conv, number, repeated, new):
    """The text of a window, the places of its turns, and the places of the targets among the new ones."""
    parts, turns, loss, at = [], [], [], 0
    for i, (role, text, _, _) in enumerate(repeated + new):
        shown, inner = escaped_role(role), escaped(text)
        role_start = at + len(BEGIN)
        start = role_start + len(shown) + 1
        turns.append({"role_start": role_start, "role_stop": start - 1, "start": start, "stop": start + len(inner)})
        if i >= len(repeated) and role == "assistant":
            loss.append({"start": start, "stop": start + len(inner)})
        parts.append(f"{BEGIN}{shown}\n{inner}{END}\n")
        at += len(parts[-1])
    return conv, number, "".join(parts), len(repeated), turns, loss, sum(t[2] for t in repeated + new)


def counter(tokenizer):
    """Number of tokens of a formatted turn under a tokenizer file."""
    from tokenizers import Tokenizer
    loaded = Tokenizer.from_file(tokenizer)
    return lambda text: len(loaded.encode(text, add_special_tokens=False).ids)


def format_conversations(turns, tokenizer, budget=1024, history=256, conv_column="conv_id", turn_column="turn", role_column="role",
                         text_column="text"):
    """Training windows of every conversation: conv_id, window, text, n_repeated (leading turns that are only
    context), turns and loss (places in the text, code points), tokens.

    Every turn is new in exactly one window, and every new assistant text is a target there, so each is
    trained on once; repeated turns are masked. NULL texts and roles count as empty. Turns rank by
    number (NULL first), then role and text; repeated rows are turns of their own, and NULL ids form one
    conversation. Windows follow from each other, so a conversation is read in order by one task, as a
    stream: memory holds one window, whatever the conversation's length.
    """
    rows = turns.select(
        turns[conv_column].cast("long").alias("conv_id"), turns[turn_column].cast("long").alias("turn"),
        F.coalesce(turns[role_column].cast("string"), F.lit("")).alias("role"), F.coalesce(turns[text_column].cast("string"), F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches):
        import pyarrow as pa
        count = counter(tokenizer)
        span = pa.struct([("start", pa.int32()), ("stop", pa.int32())])
        place = pa.struct([(n, pa.int32()) for n in ("role_start", "role_stop", "start", "stop")])
        types = [pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.list_(place), pa.list_(span), pa.int64()]
        names = ["conv_id", "window", "text", "n_repeated", "turns", "loss", "tokens"]

        def table(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        current, done = None, []
        for batch in batches:
            for conv, role, text in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3)):
                if current is None or conv != current.conv:
                    if current is not None:
                        done.append(current.close())
                    current = Windows(conv, budget, history, count)
                row = current.add(role.as_py(), text.as_py())
                if row is not None:
                    done.append(row)
                if len(done) >= 500:
                    yield table(done)
                    done = []
        if current is not None:
            done.append(current.close())
            yield table(done)

    return rows.mapInArrow(run, WINDOW)


def digests(windows):
    """What the windows say, read back: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    The digests run over whole conversations, so each is read in order by one task, as a stream.
    """
    rows = windows.select("conv_id", "window", "text", "n_repeated", "turns", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "window")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches):
        import hashlib
        import pyarrow as pa
        names = [c.split()[0] for c in schema.split(", ")]
        types = ["int64", "int64", "string", "int64", "string", "int64"]
        state, done = None, []

        def finished():
            return state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]

        for batch in batches:
            for at in range(batch.num_rows):
                conv, _, text, repeated, turns, loss = (batch.column(i)[at].as_py() for i in range(6))
                if state is None or state[0] != conv:
                    if state is not None:
                        done.append(finished())
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for t in turns[repeated:]:
                    state[1] += 1
                    role = unescaped_role(text[t["role_start"]:t["role_stop"]])
                    state[2].update(f"{role}\n{unescaped(text[t['start']:t['stop']])}\n".encode())
                for s in loss:
                    target = unescaped(text[s["start"]:s["stop"]])
                    state[3] += len(target)
                    state[4].update(target.encode())
                state[5] += len(text)
            if len(done) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names)
                done = []
        if state is not None:
            done.append(finished())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names)

    return rows.mapInArrow(run, schema)
