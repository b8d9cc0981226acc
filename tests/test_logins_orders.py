import random
from datetime import datetime, timedelta

from conftest import rows, ts
from pyspark.sql import functions as F

from ubeat.operators.logins import login_fail_pair, login_fail_timer
from ubeat.operators.orders import order_timeout, tx_match, tx_pair
from ubeat.operators.patterns import login_fail_sequence, order_pay_pattern

LOGIN = "user_id long, ip string, event_type string, ts timestamp_ntz, seq long"
T0 = 1_600_000_000


def _logins(spark, data):
    return spark.createDataFrame([(u, "1.2.3.4", e, ts(t), n) for n, (u, e, t) in enumerate(data)], LOGIN)


# User 77: a span that a late success closes, then three fails that arrive out of order;
# user 8 fails alone, user 9 is cleared in time.
CASE = [(77, "fail", T0), (8, "fail", T0 + 30), (77, "fail", T0 + 4), (9, "fail", T0 + 1), (77, "success", T0 + 9),
        (77, "fail", T0 + 20), (9, "fail", T0 + 3), (77, "fail", T0 + 17), (9, "success", T0 + 4), (77, "fail", T0 + 21)]


def test_login_fail_timer_case(spark):
    got = rows(login_fail_timer(_logins(spark, CASE), 2, "5 seconds"), "user_id", "first_fail", "last_fail", "msg")
    assert got == [(77, ts(T0), ts(T0 + 4), "login fail in 2s for 2 times"),
                   (77, ts(T0 + 20), ts(T0 + 21), "login fail in 2s for 3 times")]


def test_login_fail_pair_case(spark):
    got = rows(login_fail_pair(_logins(spark, CASE), "2 seconds"), "user_id", "first_fail", "last_fail", "msg")
    assert got == [(77, ts(T0 + 20), ts(T0 + 17), "login fail 2 times in 2 seconds")]


def test_login_fail_sequence_case(spark):
    got = rows(login_fail_sequence(_logins(spark, CASE), 3, "5 seconds"), "user_id", "first_fail", "last_fail", "msg")
    assert got == [(77, ts(T0 + 17), ts(T0 + 21), "login fail")]


def test_login_fail_sequence_overlaps_and_bound(spark):
    data = [(1, "fail", T0 + i) for i in range(4)] + [(2, "fail", T0), (2, "fail", T0 + 2), (2, "fail", T0 + 5)]
    got = rows(login_fail_sequence(_logins(spark, data), 3, "5 seconds"), "user_id", "first_fail")
    assert got == [(1, ts(T0)), (1, ts(T0 + 1))]  # user 2 spans exactly 5 s: not < 5 s


def _timer_model(events, n, wait):
    """Brute force of the P3 table rule over (user, is_fail, t) in arrival order."""
    out, state = [], {}
    for u, fail, t in events:
        anchor, span = state.get(u, (None, []))
        if fail:
            if anchor is None:
                anchor, span = t, [t]
            elif t < anchor + wait:
                span = span + [t]
            else:
                if len(span) >= n:
                    out.append((u, span[0], span[-1], len(span)))
                anchor, span = t, [t]
        else:
            if anchor is not None and t >= anchor + wait and len(span) >= n:
                out.append((u, span[0], span[-1], len(span)))
            anchor, span = None, []
        state[u] = (anchor, span)
    for u, (anchor, span) in state.items():
        if anchor is not None and len(span) >= n:
            out.append((u, span[0], span[-1], len(span)))
    return sorted(out)


def test_login_fail_timer_brute_force(spark):
    rnd = random.Random(3)
    data, t = [], T0
    for _ in range(600):
        t += rnd.choice([0, 1, 1, 2, 3, 8])
        jitter = rnd.choice([0, 0, 0, -2, 1])  # out-of-order arrivals
        data.append((rnd.choice([1, 1, 1, 2, 3]), rnd.choice(["fail", "fail", "success"]), t + jitter))
    df = _logins(spark, data)
    for n, wait in [(2, 5), (3, 4)]:
        got = rows(login_fail_timer(df, n, f"{wait} seconds", blocks=5),
                   "user_id", "first_fail", "last_fail", "msg")
        want = [(u, ts(a), ts(b), f"login fail in 2s for {k} times")
                for u, a, b, k in _timer_model([(u, e == "fail", tt) for u, e, tt in data], n, wait)]
        assert got == want


ORDER = "order_id long, event_type string, tx_id string, ts timestamp_ntz, seq long"


def _orders(spark, data):
    return spark.createDataFrame([(o, e, x, ts(t), n) for n, (o, e, x, t) in enumerate(data)], ORDER)


ORDERS = [(1, "create", None, T0), (1, "pay", "tx1", T0),              # paid, gap 0
          (2, "create", None, T0 + 20), (2, "pay", "tx2", T0 + 1058),  # paid after 15 min
          (3, "pay", "tx3", T0 + 57),                                  # no create
          (4, "create", None, T0 + 56)]                                # never paid


def test_order_timeout_outcomes(spark):
    got = rows(order_timeout(_orders(spark, ORDERS), "15 minutes"), "order_id", "tag", "result")
    assert got == [(1, "payed", "payed successfully"), (2, "timeout", "payed but already timeout"),
                   (3, "timeout", "payed but not found create log"), (4, "timeout", "order timeout")]


def test_order_timeout_covers_every_event_of_repeated_cycles(spark):
    rnd = random.Random(8)
    data = [(rnd.choice([1, 1, 1, 2, 3]), rnd.choice(["create", "pay"]), None, T0 + rnd.randrange(4000)) for _ in range(300)]
    want = []
    for o in (1, 2, 3):
        evs = sorted((t, e, n) for n, (k, e, _, t) in enumerate(data) if k == o)
        for i, (t, e, _) in enumerate(evs):
            nxt = evs[i + 1] if i + 1 < len(evs) else (None, "create")
            if e == "create" and nxt[1] == "pay":
                want.append((o, ts(t), ts(nxt[0]), "payed successfully" if nxt[0] - t < 20 else "payed but already timeout"))
            elif e == "create":
                want.append((o, ts(t), None, "order timeout"))
            elif i == 0 or evs[i - 1][1] == "pay":
                want.append((o, None, ts(t), "payed but not found create log"))
    got = order_timeout(_orders(spark, data), "20 seconds", blocks=6)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, got.select("order_id", "create_ts", "pay_ts", "result").collect())) == sorted(map(key, want))
    assert got.agg(F.count("create_ts") + F.count("pay_ts")).first()[0] == len(data)


def test_order_pay_pattern(spark):
    got = rows(order_pay_pattern(_orders(spark, ORDERS), "15 minutes"), "order_id", "tag", "result")
    assert got == [(1, "payed", "payed success"),
                   (2, "timeout", f"timeout : {(T0 + 20 + 900) * 1000}"),
                   (4, "timeout", f"timeout : {(T0 + 56 + 900) * 1000}")]


def test_tx_match_bounds(spark):
    pays = spark.createDataFrame([(1, "a", ts(T0), 0), (2, "b", ts(T0), 1), (3, "c", ts(T0), 2), (4, "d", ts(T0), 3)],
                                 "order_id long, tx_id string, ts timestamp_ntz, seq long")
    rec = spark.createDataFrame([("a", "wechat", ts(T0 + 5), 0), ("b", "alipay", ts(T0 - 3), 1),
                                 ("c", "wechat", ts(T0 + 6), 2), ("e", "wechat", ts(T0), 3)],
                                "tx_id string, pay_channel string, ts timestamp_ntz, seq long")
    got = rows(tx_match(pays, rec, "5 seconds", "3 seconds", bucket="4 seconds"), "tag", "tx_id")
    assert got == [("matched", "a"), ("matched", "b"), ("unmatched_pay", "c"), ("unmatched_pay", "d"),
                   ("unmatched_receipt", "c"), ("unmatched_receipt", "e")]


def _pair_model(pays, receipts, pw, rw):
    """Brute force: every event looks through all waiting events of the other side."""
    events = sorted([(k, t, 0, s) for k, t, s in pays] + [(k, t, 1, s) for k, t, s in receipts])
    waiting, out = [], []
    for k, t, side, s in events:
        found = next((w for w in waiting if w[0] == k and w[2] != side and t - w[1] <= (rw if w[2] else pw)), None)
        if found:
            waiting.remove(found)
            out.append(("matched", s, found[3]) if side == 0 else ("matched", found[3], s))
        else:
            waiting.append((k, t, side, s))
    return sorted(out + [("unmatched_receipt", None, s) if side else ("unmatched_pay", s, None) for _, _, side, s in waiting], key=repr)


def test_tx_pair_equals_a_model(spark, monkeypatch):
    from ubeat.plans import scan
    rng = random.Random(6)
    pays, receipts = [], []
    for i in range(900):
        # Key "hot" has a third of the events, many of one instant; the others have pauses.
        k = "hot" if i % 3 == 0 else f"k{rng.randrange(12)}"
        t = rng.randrange(150) if k == "hot" else rng.randrange(600)
        (pays if rng.random() < 0.5 else receipts).append((k, t, i))
    p = spark.createDataFrame([(k, ts(T0 + t), s, 5) for k, t, s in pays] + [(None, ts(T0), 9000, 5)], "tx_id string, ts timestamp_ntz, seq long, order_id long")
    r = spark.createDataFrame([(k, ts(T0 + t), s, "x") for k, t, s in receipts] + [(None, ts(T0), 9001, "x")], "tx_id string, ts timestamp_ntz, seq long, pay_channel string")
    want = sorted(_pair_model(pays, receipts, 5, 3) + [("unmatched_pay", 9000, None), ("unmatched_receipt", None, 9001)], key=repr)
    for most in (1_000_000, 20):
        monkeypatch.setattr(scan, "ROWS_PER_BLOCK", most)
        got = tx_pair(p, r, "5 seconds", "3 seconds").collect()
        assert sorted(((x.tag, x.pay_seq, x.receipt_seq) for x in got), key=repr) == want
        assert all((x.pay_order_id == 5) == (x.pay_seq is not None) and (x.receipt_pay_channel == "x") == (x.receipt_seq is not None) for x in got)
    assert tx_pair(p.limit(0), r.limit(0)).count() == 0


def test_tx_pair_query_equals_the_model(spark):
    import __spark_entry__ as entry
    from ubeat.sources import tables as tb
    sf = "/root/testdata/sf0.001"
    ev = tb.load(spark, sf, "events")
    rows_of = lambda df: [(x.tx_id, (x.ts - datetime(1970, 1, 1)) // timedelta(microseconds=1), x.seq) for x in df.collect()]
    want = _pair_model(rows_of(tb.pays(ev)), rows_of(tb.receipts(ev)), 5 * 3_600_000_000, 3 * 3_600_000_000)
    got = entry.queries()["tx_pair"](spark, sf).collect()
    assert sorted(((x.tag, x.pay_seq, x.receipt_seq) for x in got), key=repr) == want
