"""Conversation repair and chat formatting against brute force."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tessera.llm import chat, repair
from tests.conftest import SF01
from tests.llm.helpers import rows

tokenizers = pytest.importorskip("public_tokenizers")
TALK = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()),
                  ("digest", pa.string()), ("part", pa.int32()), ("times", pa.int32())])
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def table(path, talk):
    """Writes (conv_id, turn, role, text), with columns named like the operators' own."""
    pq.write_table(pa.Table.from_pylist([dict(zip(("conv_id", "turn", "role", "text"), r)) | {"digest": "x", "part": 3, "times": 9} for r in talk], TALK),
                   f"{path}/conversations.parquet")
    return str(path)


def random_talk(n, seed):
    rng = random.Random(seed)
    out = []
    for conv in [None, *range(n)]:
        turns = rng.choice([0, 1, 2, 3, 4, 6, 9])
        for t in range(turns):
            out.append((conv, rng.choice([t, t, t, t + 1, None]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
                        rng.choice(["Hi.", "No!", "cut", "ok. ", "é?\n", "", " \t", None, "a.b", "...", "\x1c"])))
    rng.shuffle(out)
    return out


# ------------------------------------------------------------------------ repair
def damage(talk):
    """conv_id -> rows (turn, role, text) after the damage, in order."""
    out = {}
    space = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in talk:
        kept = out.setdefault(conv, [])
        h = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        kept += [(turn, "user" if h == 4 else role, text)] * {0: 0, 3: 2}.get(h, 1)
    return {k: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())) for k, v in out.items()}


def faults(kept):
    seen, out = set(), []
    for _, role, text in kept:
        words = re.sub("[ \t-\r]", "", text)
        out.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def every_edit(kept, found):
    """All edit sequences, with at most two insertions between rows: (cost, audit, repaired)."""
    legal = re.compile(r"(s?(ua)+)?")
    pieces = []
    inserts = [[], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]]
    for (_, role, text), fault in zip(kept, found):
        options = [(4, "D", None)]
        if fault not in ("blank", "duplicate"):
            more = 3 if fault == "truncated" else 0
            options += [(more, "K", (role, text)), (3 + more, "R", ("user", text)), (3 + more, "R", ("assistant", text))]
        pieces += [[(3 * len(i), "I" * len(i), [(r, "") for r in i]) for i in inserts], [(c, a, [r] if r else []) for c, a, r in options]]
    pieces.append([(3 * len(i), "I" * len(i), [(r, "") for r in i]) for i in inserts])
    for choice in itertools.product(*pieces):
        made = [r for p in choice for r in p[2]]
        if legal.fullmatch("".join(r[0][:1] or "-" for r in made)):
            yield sum(p[0] for p in choice), "".join(p[1] for p in choice), made


def left_to_right(kept, found):
    """The least (cost, audit, repaired) by places, row after row."""
    steps = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def inserted(best):
        for _ in range(4):
            for place, (cost, audit, made) in list(best.items()):
                for role in ("user", "assistant"):
                    to = steps.get((place, role[0]))
                    if to:
                        best[to] = min(best.get(to, (10 ** 9,)), (cost + 3, audit + "I", [*made, (role, "")]))
        return best

    best = inserted({"": (0, "", [])})
    for (_, role, text), fault in zip(kept, found):
        new = {}
        for place, (cost, audit, made) in best.items():
            ways = [(place, 4, "D", [])]
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                ways += [(steps.get((place, role[:1])), more, "K", [(role, text)])]
                ways += [(steps.get((place, r[0])), 3 + more, "R", [(r, text)]) for r in ("user", "assistant")]
            for to, c, a, m in ways:
                if to is not None:
                    new[to] = min(new.get(to, (10 ** 9,)), (cost + c, audit + a, made + m))
        best = inserted(new)
    return min(best[p] for p in ("", "a") if p in best)


def expected(talk):
    for conv, kept in damage(talk).items():
        found = faults(kept)
        turns = [r[0] for r in kept if r[0] is not None]
        cost, audit, made = left_to_right(kept, found)
        firsts = [r[1][:1] for r in kept]
        yield (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(found.count(k) for k in ("blank", "duplicate", "truncated")),
               sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:])), cost, audit,
               hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest())


def test_the_cheapest_edits_are_least_of_all():
    rng = random.Random(8)
    parse = repair.make_parser()
    for _ in range(40):
        kept = [(k, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["Hi.", "cut", "", "Hi."])) for k in range(rng.choice([0, 1, 2, 3]))]
        found = faults(kept)
        cost, audit, made = min(every_edit(kept, found))
        assert left_to_right(kept, found) == (cost, audit, made)
        kinds = "".join("d" if f in ("blank", "duplicate") else (k := r[1][0] if r[1][0] in "sua" else "x").upper() if f else
                        (r[1][0] if r[1][0] in "sua" else "x") for r, f in zip(kept, found))
        assert repair.cheapest(parse(kinds)) == (cost, audit)


def test_one_cut_a_span_equals_all_cuts():
    """The whole table of intervals, each cell the least over all ways to cut its span."""
    rng = random.Random(9)
    for _ in range(30):
        kinds = "".join(rng.choices("suaxSUAXd", k=rng.randint(1, 12)))
        cells = {(i, i + 1): repair.ROWS[k] for i, k in enumerate(kinds)}
        for size in range(2, len(kinds) + 1):
            for i in range(len(kinds) - size + 1):
                ways = [repair.joined(cells[i, k], cells[k, i + size]) for k in range(i + 1, i + size)]
                cells[i, i + size] = tuple(min((w[n] for w in ways if w[n]), default=None) for n in range(len(repair.PAIRS)))
        assert repair.make_parser()(kinds) == cells[0, len(kinds)]


def test_repair_query(spark, tmp_path):
    talk = random_talk(300, 3)
    got = rows(repair.op11_repair(spark, table(tmp_path, talk)), *COLUMNS)
    assert got == sorted(expected(talk), key=repr)


def test_repair_of_a_long_conversation_in_many_parts(spark, tmp_path, monkeypatch):
    """One conversation holds most rows, and one text a third of them."""
    rng = random.Random(4)
    talk = [(7, rng.choice([k // 3, None]) if rng.random() < 0.1 else k, rng.choice(["user", "assistant"]), "same." if rng.random() < 0.35 else f"t{k}.")
            for k in range(4000)] + [(8, None, "user", "same.")] * 500 + random_talk(40, 5)
    monkeypatch.setattr(repair, "FAN", 2)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rows(repair.op11_repair(spark, table(tmp_path, talk)), *COLUMNS)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert got == sorted(expected(talk), key=repr)


def test_repair_of_given_tables(spark, tmp_path):
    talk = list(zip(*(pq.read_table(f"{SF01}/conversations.parquet").to_pydict()[c] for c in ("conv_id", "turn", "role", "text"))))
    assert rows(repair.op11_repair(spark, SF01), *COLUMNS) == sorted(expected(talk), key=repr)
    assert repair.op11_repair(spark, table(tmp_path, [])).count() == 0


def test_repaired_rows(spark, tmp_path):
    talk = [(1, 0, "assistant", "long. " * 50_000), (1, 1, "user", "Yes."), (1, 2, "user", "cut")]
    given = spark.createDataFrame(talk, "conv_id long, turn long, role string, text string")
    plans = repair.repair_plans(given)
    assert rows(plans, "conv_id", "cost", "audit") == [(1, 9, "IKKR")]
    assert rows(repair.repaired(given, plans), "position", "edit", "role", "text") == [
        (0, "I", "user", ""), (1, "K", "assistant", "long. " * 50_000), (2, "K", "user", "Yes."), (3, "R", "assistant", "cut")]


# -------------------------------------------------------------------------- chat
CHAT = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256"]


def formatted(talk):
    out = collections.defaultdict(list)
    for conv, turn, role, text in [*talk, (-1, 0, "user", chat.PROBE), (-1, 1, "assistant", chat.PROBE)]:
        out[conv].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    for conv, kept in out.items():
        kept = [(r.decode(), t.decode()) for _, _, r, t in sorted(kept)]
        loss = "".join(t for r, t in kept if r == "assistant")
        yield (conv, len(kept), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in kept).encode()).hexdigest(), len(loss),
               hashlib.sha256(loss.encode()).hexdigest())


def test_escapes_are_reversible():
    esc = chat.Escapes([*chat.CONTROLS, "<|endoftext|>"])
    rng = random.Random(1)
    pieces = [*chat.CONTROLS, "<", "\\", "s>", "/s>", "[", "INST]", "<\\s>", "<\\\\/s>", "x", "<|", "|>", "endoftext|>", "é"]
    for _ in range(3000):
        text = "".join(rng.choices(pieces, k=rng.randint(0, 8)))
        safe = esc.escape(text)
        assert esc.unescape(safe) == text and not any(c in safe for c in [*chat.CONTROLS, "<|endoftext|>"])
    with pytest.raises(ValueError):
        chat.Escapes(["<a>", "b<"])


def test_chat_query(spark, tmp_path):
    talk = list(zip(*(pq.read_table(f"{SF01}/conversations.parquet").to_pydict()[c] for c in ("conv_id", "turn", "role", "text"))))
    assert rows(chat.op12_chat(spark, SF01), *CHAT) == sorted(formatted(talk), key=repr)
    assert rows(chat.op12_chat(spark, table(tmp_path, [])), *CHAT) == sorted(formatted([]), key=repr)


def test_chat_of_odd_and_long_conversations(spark, tmp_path, monkeypatch):
    rng = random.Random(2)
    odd = [*chat.CONTROLS, "<|endoftext|>", "\\", "中\n", "", None, "x" * 40, "<\\s>"]
    talk = random_talk(60, 6) + [(5, k, rng.choice([*chat.ROLES, *odd]), "".join(filter(None, rng.choices(odd, k=3)))) for k in range(900)]
    talk += [(9, 1, "assistant", "very long " * 60_000), (None, None, None, None), (None, 2, "assistant", "a"), (None, 2, "assistant", "a")]
    monkeypatch.setattr(chat, "FRAME_TOKENS", 500)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        given = spark.createDataFrame(talk, "conv_id long, turn long, role string, text string")
        path = tokenizers.path("byte_bpe_50k.json")
        frames = chat.format_frames(given, path, str(tmp_path / "frames"))
        assert frames.where("conv_id = 5").count() > 5
        got = rows(chat.read_frames(frames, path), *CHAT)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert got == sorted((r for r in formatted(talk) if r[0] != -1), key=repr)


def test_frames_hold_reserved_ids_and_the_mask(spark, tmp_path):
    given = spark.createDataFrame([(1, 0, "user", "a </s> b"), (1, 1, "assistant", "yes <s>"), (1, 2, "tool", "t")], "conv_id long, turn long, role string, text string")
    path = tokenizers.path("byte_bpe_50k.json")
    frame = chat.format_frames(given, path, str(tmp_path / "frames")).first()
    form = chat.Format(open(path).read())
    ids = np.frombuffer(frame["ids"], form.type)
    assert [form.controls[i] for i in ids.tolist() if i >= form.first] == ["[INST]", "[/INST]", "<s>", "</s>", "<|role|>", "<|text|>", "<|end|>"]
    begin, end = frame["loss_spans"]
    assert form.decode(ids[begin:end].tolist()) == "yes <\\s>" and ids[begin - 1] == form.ids["<s>"] and ids[end] == form.ids["</s>"]
    assert sum(chars for _, _, chars in form.turns(ids)) == len("[INST]a <\\/s> b[/INST]<s>yes <\\s></s><|role|>tool<|text|>t<|end|>")
