"""Writes the CSV fixtures of the tests: invented rows that hit the operators' edges.

Edges: failed logins 1, 2 and 3 seconds apart, around a success and at equal
times; orders paid in time, at, just before and after 15 minutes, re-created,
paid without a create; receipts 3 and 4 seconds before and 5 and 6 seconds
after their pay, and without a partner; a user with 121 clicks on one ad in a
day, and rows that go back in time.
"""

import os
import random

HERE = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tests", "fixtures")
T0 = 1_700_000_000


def write(name, rows, rng, disorder):
    """Rows in time order, then each delayed by up to ``disorder`` seconds."""
    rows = sorted(rows, key=lambda r: r[-1])
    rows = sorted(rows, key=lambda r: r[-1] + rng.uniform(0, disorder))
    with open(os.path.join(HERE, name), "w") as f:
        f.write("\n".join(",".join(map(str, r)) for r in rows))


def logins(rng):
    rows = [(u, f"10.0.0.{u % 250}", rng.choice(["success", "success", "fail"]), T0 + rng.randint(0, 120))
            for u in range(100, 140) for _ in range(rng.randint(1, 3))]
    chain = {7: [0, 1, 2, 4], 8: [10, 12, 14], 9: [20, 23, 26], 11: [30, 30, 31], 12: [40, 41, 42, 43, 44, 45, 46]}
    for user, at in chain.items():
        rows += [(user, "10.1.1.1", "fail", T0 + t) for t in at]
    rows += [(10, "10.1.1.2", k, T0 + t) for k, t in (("fail", 50), ("success", 51), ("fail", 52), ("fail", 53))]
    return rows


def orders(rng):
    rows, late = [], {900: 899, 901: 900, 902: 901, 903: 1300}
    for o in [*range(1, 36), *late]:
        at = T0 + rng.randint(0, 200)
        rows += [(o, "create", "", at), (o, "pay", f"tx{o}", at + late.get(o, rng.randint(1, 300)))]
    rows += [(950, "create", "", T0 + 5), (951, "pay", "tx951", T0 + 9),
             (952, "create", "", T0 + 10), (952, "create", "", T0 + 700), (952, "pay", "tx952", T0 + 1400),
             (953, "create", "", T0 + 20), (953, "pay", "tx953", T0 + 21), (953, "pay", "tx953b", T0 + 22)]
    return rows


def receipts(rng, pays):
    rows = []
    for k, (_, _, tx, at) in enumerate(sorted(pays)):
        gap = [-4, -3, 0, 3, 5, 6, None, 40][k % 8]
        if gap is not None:
            rows.append((tx, rng.choice(["wechat", "alipay"]), at + gap))
    return rows + [(f"zz{k}", "alipay", T0 + 11 * k) for k in range(6)]


def clicks(rng):
    places = [("north", "n1"), ("south", "s1"), ("east", "e1"), ("west", "w1")]
    rows = [(u, rng.randint(1, 4), *rng.choice(places), T0 + rng.randint(0, 5400)) for u in range(200, 222)]
    rows += [(77, 3, "north", "n1", T0 + 20 * k) for k in range(121)]
    # the UTC+8 day after T0 starts at T0 - T0 % 86400 + 57600
    rows += [(77, 3, "north", "n1", T0 - T0 % 86400 + 57600 + 60 * k) for k in range(5)]
    return rows


def main():
    rng = random.Random(20)
    write("logins.csv", logins(rng), rng, 4)
    pays_and_creates = orders(rng)
    write("order_events.csv", pays_and_creates, rng, 6)
    write("receipts.csv", receipts(rng, [r for r in pays_and_creates if r[1] == "pay"]), rng, 3)
    write("ad_clicks.csv", clicks(rng), rng, 30)


if __name__ == "__main__":
    main()
