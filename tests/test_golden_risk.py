"""The studied pipeline's committed risk snapshot: 161 agent-days, 5 agents.

Inputs are the four daily counts per agent-day plus each agent's tier
ceilings; every scored column must come out identical.
"""

import csv
import os

from activity_engine.operators import risk

HERE = os.path.dirname(os.path.abspath(__file__))

# The five agents' tier ceilings (invites, messages) in that snapshot.
CEILINGS = {1: (5, 10), 2: (10, 15), 3: (15, 25), 4: (25, 40), 5: (30, 60)}


def load():
    with open(os.path.join(HERE, "golden", "risk_daily_161.csv")) as f:
        return list(csv.DictReader(f))


def test_snapshot_reproduced_exactly(spark):
    rows = load()
    assert len(rows) == 161
    inputs = [(int(r["agent_sk"]), int(r["date_key"]), int(r["invites_sent"]),
               int(r["invites_accepted"]), int(r["messages_sent"]), int(r["replies_received"]),
               *CEILINGS[int(r["agent_sk"])]) for r in rows]
    df = spark.createDataFrame(inputs, "agent_sk long, date_key int, invites_sent long, "
                                       "invites_accepted long, messages_sent long, "
                                       "replies_received long, daily_invite_ceiling int, "
                                       "daily_message_ceiling int")
    got = {(r.agent_sk, r.date_key): r for r in risk.score_daily(df).collect()}
    assert len(got) == 161
    mism = []
    for r in rows:
        g = got[(int(r["agent_sk"]), int(r["date_key"]))]
        exp = (float(r["acceptance_rate"]), float(r["reply_rate"]),
               float(r["invite_limit_utilization_pct"]), float(r["message_limit_utilization_pct"]),
               float(r["anomaly_score"]), r["risk_level"], int(r["recommended_invite_capacity"]),
               int(r["recommended_message_capacity"]))
        act = (g.acceptance_rate, g.reply_rate, g.invite_limit_utilization_pct,
               g.message_limit_utilization_pct, g.anomaly_score, g.risk_level,
               g.recommended_invite_capacity, g.recommended_message_capacity)
        if act != exp:
            mism.append((r["agent_sk"], r["date_key"], exp, act))
    assert mism == []
    levels = [r["risk_level"] for r in rows]
    assert (levels.count("NORMAL"), levels.count("WARNING"), levels.count("CRITICAL")) == (130, 20, 11)
