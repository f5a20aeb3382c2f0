"""DuckDB SQL for the registered queries.

Written from typed columns of ``events``, never through JSON, so that it checks
parsing and casting too. ``CTES`` holds the shared tables, in dependency order.
"""

from __future__ import annotations

from corridor.operators.scoring import Layer
from corridor.plans.layers import example_network, other_network, wide_network

START = "TIMESTAMP '2024-01-01 00:00:00'"
EVENT_COLUMNS = """event_id, timestamp_utc, train_id, block_id, block_idx, subdivision,
    current_speed_mph, max_authorized_speed_mph, gross_tonnage, signal_aspect_ahead,
    schedule_adherence_sec, track_grade_pct"""
STATE_COLUMNS = """block_id, block_idx, signal_aspect, speed_mph, schedule_adherence_sec,
    track_grade_pct"""
WHOLE_OR_NULL = ("block_idx", "gross_tonnage", "n_blocks_ahead")
OCCUPANCY_COLUMNS = f"window_start, window_end, train_id, {STATE_COLUMNS}"


def _events(fleet: bool) -> str:
    train = "'T_' || lpad((tr + 1)::VARCHAR, greatest(3, length((tr + 1)::VARCHAR))::INTEGER, '0')"
    subdivision = "'Harrisburg_Sub'"
    if fleet:
        train = "'T_' || lpad((user_id + 1)::VARCHAR, greatest(4, length((user_id + 1)::VARCHAR))::INTEGER, '0')"
        subdivision = "'Sub_' || lpad((user_id % 30)::VARCHAR, greatest(2, length((user_id % 30)::VARCHAR))::INTEGER, '0')"
    return f"""
    SELECT n, tr, bi,
      'E_' || lpad(n::VARCHAR, greatest(12, length(n::VARCHAR))::INTEGER, '0') AS event_id,
      {START} + to_seconds(2 * tick - CASE WHEN n % 97 = 0 THEN 45 ELSE 0 END) AS true_time,
      CASE WHEN n % 59 <> 0 THEN true_time END AS event_time,
      CASE WHEN n % 59 = 0 THEN 'not-a-date'
           ELSE strftime(true_time, '%Y-%m-%dT%H:%M:%S') || '+00:00' END AS timestamp_utc,
      CASE WHEN n % 47 <> 0 THEN {train} END AS train_id,
      CASE WHEN n % 67 = 0 THEN NULL WHEN n % 53 = 0 THEN 'B_021'
           ELSE 'B_' || lpad((bi + 1)::VARCHAR, greatest(3, length((bi + 1)::VARCHAR))::INTEGER, '0') END AS block_id,
      (CASE WHEN n % 53 = 0 THEN 20 ELSE bi END)::INTEGER AS block_idx,
      {subdivision} AS subdivision,
      (CASE WHEN n % 73 = 0 THEN NULL WHEN n % 43 = 0 THEN 85.0::DOUBLE
            WHEN n % 83 = 0 THEN (-1.0)::DOUBLE
            ELSE (floor(value * 10)::BIGINT % 791)::DOUBLE / 10.0::DOUBLE END)::FLOAT
        AS current_speed_mph,
      79::FLOAT AS max_authorized_speed_mph,
      18400::INTEGER AS gross_tonnage,
      CASE WHEN n % 71 = 0 THEN NULL WHEN n % 41 = 0 THEN 'flashing'
           WHEN event_type = 'error' THEN 'stop'
           WHEN event_type IN ('purchase', 'signup') THEN 'approach'
           ELSE 'clear' END AS signal_aspect_ahead,
      (CASE WHEN n % 3 = 0 THEN 0 ELSE 1 END)::INTEGER AS n_blocks_ahead,
      'B_' || lpad(((bi + 1) % 20 + 1)::VARCHAR, greatest(3, length(((bi + 1) % 20 + 1)::VARCHAR))::INTEGER, '0') AS ahead_block_id,
      'T_' || lpad(((tr + 1) % 5 + 1)::VARCHAR, greatest(3, length(((tr + 1) % 5 + 1)::VARCHAR))::INTEGER, '0') AS occupying_train,
      (60 + n % 241)::FLOAT AS estimated_clearance_sec,
      (CASE WHEN n % 79 <> 0 THEN (n * 37) % 901 - 600 END)::FLOAT AS schedule_adherence_sec,
      (((n * 13) % 301 - 150)::DOUBLE / 100.0::DOUBLE)::FLOAT AS track_grade_pct
    FROM (SELECT event_id AS n, event_id // 5 AS tick, event_id % 5 AS tr, user_id,
            event_type, value, (tick // (3 + tr) + 4 * tr) % 20 AS bi FROM events)"""


def _silver(events: str) -> str:
    return f"""
    SELECT * FROM {events}
    WHERE n % 61 <> 0 AND train_id IS NOT NULL AND block_id IS NOT NULL
      AND event_time IS NOT NULL AND signal_aspect_ahead IN ('clear', 'approach', 'stop')
      AND current_speed_mph >= 0 AND current_speed_mph <= 79
      AND block_idx >= 0 AND block_idx < 20"""


def _occupancy(silver: str, keys: str) -> str:
    return f"""
    SELECT window_start, window_start + INTERVAL 30 SECOND AS window_end, {keys},
      s.block_id, s.block_idx, s.signal_aspect, s.speed_mph, s.schedule_adherence_sec,
      s.track_grade_pct
    FROM (
      SELECT window_start, {keys}, arg_max(
          {{'block_id': block_id, 'block_idx': block_idx,
            'signal_aspect': signal_aspect_ahead, 'speed_mph': current_speed_mph,
            'schedule_adherence_sec': schedule_adherence_sec,
            'track_grade_pct': track_grade_pct}}, (event_time, event_id)) AS s
      FROM (SELECT *, time_bucket(INTERVAL 10 SECOND, event_time) - to_seconds(10 * back)
              AS window_start
            FROM {silver}, (SELECT unnest([0, 1, 2]) AS back))
      GROUP BY window_start, {keys})"""


def _gold(occupancy: str) -> str:
    return f"""
    SELECT *, CASE WHEN shockwave_delay_sec > 180 THEN 'critical'
                   WHEN shockwave_delay_sec > 60 THEN 'moderate' ELSE 'nominal' END
        AS delay_severity
    FROM (SELECT * EXCLUDE (late, slow),
        CASE signal_aspect
          WHEN 'stop' THEN late + 120.0::DOUBLE + slow * 60.0::DOUBLE
          WHEN 'approach' THEN late * 0.5::DOUBLE + 30.0::DOUBLE + slow * 20.0::DOUBLE
          ELSE late * 0.1::DOUBLE END AS shockwave_delay_sec,
        CASE signal_aspect WHEN 'stop' THEN 0.0::DOUBLE
          WHEN 'approach' THEN speed_mph::DOUBLE * 0.6::DOUBLE
          ELSE 79.0::DOUBLE END AS advisory_speed_mph
      FROM (SELECT *,
          abs(least(schedule_adherence_sec::DOUBLE, 0.0::DOUBLE)) AS late,
          greatest(0.0::DOUBLE, (79.0::DOUBLE - speed_mph::DOUBLE) / 79.0::DOUBLE) AS slow
        FROM {occupancy}))"""


def _latest(table: str, columns: list[str]) -> str:
    picked = ", ".join(
        f"arg_max({c}, window_start) FILTER ({c} IS NOT NULL) AS {c}" for c in columns
    )
    return f"SELECT train_id, {picked} FROM {table} GROUP BY train_id"


GOLD_REST = [
    "window_start",
    "window_end",
    "block_id",
    "block_idx",
    "signal_aspect",
    "speed_mph",
    "schedule_adherence_sec",
    "track_grade_pct",
    "shockwave_delay_sec",
    "advisory_speed_mph",
    "delay_severity",
]

def _newest_files(n: int, files: int = 25) -> str:
    """Gold rows in the last ``n`` of the files that are written in turn."""
    return f"(SELECT * FROM gold WHERE epoch(window_start)::BIGINT // 10 % {files} >= {files - n})"


def _marey(gold: str) -> str:
    return f"""SELECT train_id, window_start, block_idx, speed_mph, schedule_adherence_sec,
          delay_severity, CASE delay_severity WHEN 'moderate' THEN 'diamond'
            WHEN 'critical' THEN 'x' ELSE 'circle' END AS marker,
          CASE train_id WHEN 'T_001' THEN '#3b82f6' WHEN 'T_002' THEN '#10b981'
            WHEN 'T_003' THEN '#f59e0b' WHEN 'T_004' THEN '#8b5cf6'
            WHEN 'T_005' THEN '#ef4444' ELSE '#6b7280' END AS colour
        FROM {gold}"""


FEATURES = """
    SELECT *,
      coalesce(speed_mph::DOUBLE, 0) / 79.0::DOUBLE AS speed_norm,
      (sig = 'stop')::INTEGER::DOUBLE AS is_stop,
      (sig = 'approach')::INTEGER::DOUBLE AS is_approach,
      (sig = 'clear')::INTEGER::DOUBLE AS is_clear,
      least(blocks_count, 2)::DOUBLE / 2.0::DOUBLE AS ahead_norm,
      greatest(least(coalesce(schedule_adherence_sec::DOUBLE, 0) / 300.0::DOUBLE, 1.0::DOUBLE),
        (-1.0)::DOUBLE) AS adherence_norm,
      greatest(least(coalesce(track_grade_pct::DOUBLE, 0) / 3.0::DOUBLE, 1.0::DOUBLE),
        (-1.0)::DOUBLE) AS grade_norm,
      block_idx::DOUBLE / 19.0::DOUBLE AS progress_norm
    FROM (SELECT *, lower(trim(signal_aspect)) AS sig,
            (signal_aspect IN ('stop', 'approach'))::INTEGER AS blocks_count FROM gold)"""

OBSERVATION = [
    "speed_norm",
    "is_stop",
    "is_approach",
    "is_clear",
    "ahead_norm",
    "adherence_norm",
    "grade_norm",
    "progress_norm",
]


def _scored(network: tuple[Layer, Layer], features: str = "features") -> str:
    hidden, out = network

    def unit(row, bias, inputs) -> str:
        terms = "".join(f" + ({w})::DOUBLE * {x}" for w, x in zip(row, inputs))
        return f"({bias})::DOUBLE{terms}"

    first = ", ".join(
        f"greatest({unit(r, b, OBSERVATION)}, 0.0::DOUBLE) AS h{i}"
        for i, (r, b) in enumerate(zip(hidden.weights, hidden.bias))
    )
    names = [f"h{i}" for i in range(len(hidden.bias))]
    second = ", ".join(unit(r, b, names) for r, b in zip(out.weights, out.bias))
    return f"""
    SELECT *, ([0.0, 20.0, 40.0, 60.0, 79.0])[list_position(logits, list_max(logits))]::DOUBLE
        AS rl_advisory_speed_mph
    FROM (SELECT *, [{second}] AS logits FROM (SELECT *, {first} FROM {features}))"""


def _scored_wide() -> str:
    """The same for three layers, with sums over lists."""
    inputs = f"[{', '.join(OBSERVATION)}]"

    def dense(layer: Layer, x: str) -> str:
        weights = [list(row) for row in layer.weights]
        return (
            f"list_transform(range(1, {len(layer.bias) + 1}), lambda i: ({list(layer.bias)}::DOUBLE[])[i]"
            f" + list_sum(list_transform(range(1, {len(weights[0]) + 1}),"
            f" lambda j: ({weights}::DOUBLE[][])[i][j] * {x}[j])))"
        )

    def squashed(values: str) -> str:
        return f"list_transform({values}, lambda v: tanh(v))"

    one, two, three = wide_network()
    return f"""
    SELECT *, ([0.0, 20.0, 40.0, 60.0, 79.0])[list_position(logits, list_max(logits))]::DOUBLE
        AS rl_advisory_speed_mph
    FROM (SELECT *, {dense(three, "second")} AS logits
      FROM (SELECT *, {squashed(dense(two, "first"))} AS second
        FROM (SELECT *, {squashed(dense(one, "inputs"))} AS first
          FROM (SELECT *, {inputs} AS inputs FROM features))))"""


STEPS = """
    SELECT *, (step - 1) // 200 AS episode_no, (step - 1) % 200 + 1 AS episode_step,
      greatest(least(
        -abs(coalesce(schedule_adherence_sec::DOUBLE, 0)) / 300.0::DOUBLE
        - 0.3::DOUBLE * greatest(0.0::DOUBLE,
            prev_speed_mph::DOUBLE - current_speed_mph::DOUBLE) / 79.0::DOUBLE
        + CASE WHEN signal_aspect_ahead = 'clear'
            THEN 0.1::DOUBLE * (current_speed_mph::DOUBLE / 79.0::DOUBLE)
            ELSE 0.0::DOUBLE END, 1.0::DOUBLE), (-2.0)::DOUBLE) AS reward
    FROM (SELECT *, row_number() OVER w AS step,
            coalesce(lag(current_speed_mph) OVER w, current_speed_mph) AS prev_speed_mph
          FROM silver WINDOW w AS (PARTITION BY train_id ORDER BY event_time, event_id))"""

EPISODES = """
    SELECT train_id, episode_no, sum(reward) AS reward,
      arg_max(coalesce(schedule_adherence_sec::DOUBLE, 0), episode_step) AS final_adherence_sec,
      avg(current_speed_mph::DOUBLE) AS avg_speed_mph,
      CASE WHEN substr(train_id, 3)::BIGINT % 2 = 1 THEN 'base' ELSE 'candidate' END AS policy
    FROM steps GROUP BY train_id, episode_no HAVING count(*) = 200"""

METRICS = """
    SELECT policy, count(*) AS n_episodes, avg(reward) AS mean_reward,
      stddev_pop(reward) AS std_reward, avg(final_adherence_sec) AS mean_adherence_sec,
      avg(avg_speed_mph) AS mean_avg_speed_mph
    FROM episodes GROUP BY policy"""

NETWORK = """
    SELECT o.*, EXISTS (SELECT 1 FROM occ p WHERE p.window_start = o.window_start
        AND p.block_idx = (o.block_idx + 1) % 20) AS next_taken,
      EXISTS (SELECT 1 FROM occ p WHERE p.window_start = o.window_start
        AND p.block_idx = (o.block_idx + 2) % 20) AS second_taken
    FROM occ o"""

NETWORK_FLEET = """
    SELECT o.*, EXISTS (SELECT 1 FROM occ_fleet p WHERE p.window_start = o.window_start
        AND p.subdivision = o.subdivision
        AND p.block_idx = (o.block_idx + 1) % 20) AS next_taken,
      EXISTS (SELECT 1 FROM occ_fleet p WHERE p.window_start = o.window_start
        AND p.subdivision = o.subdivision
        AND p.block_idx = (o.block_idx + 2) % 20) AS second_taken
    FROM occ_fleet o"""

HOLDERS = """
    SELECT window_start, block_idx, max(train_id) AS holder
    FROM occ GROUP BY window_start, block_idx"""

BLOCKS = """
    SELECT i::INTEGER AS block_idx, 'B_' || lpad((i + 1)::VARCHAR, greatest(3, length((i + 1)::VARCHAR))::INTEGER, '0') AS block_id
    FROM range(20) t(i)"""

# One delivery per trigger, every 97th row three deliveries late. A batch drops rows whose
# window ended before the watermark of its predecessor, which knows the batches before it.
PUNCTUAL = """
    SELECT *, epoch(window_end) <= coalesce(limit_sec, 0) AS late
    FROM (SELECT d.*, window_start + INTERVAL 30 SECOND AS window_end,
            epoch((SELECT max(m.latest) FROM deliveries m WHERE m.batch <= d.batch - 2)) - 30
              AS limit_sec
          FROM (SELECT *, time_bucket(INTERVAL 10 SECOND, event_time) - to_seconds(10 * back)
                  AS window_start
                FROM delivered, (SELECT unnest([0, 1, 2]) AS back)) d)"""

DELIVERED = """
    SELECT *, n // each + CASE WHEN n % 97 = 0 THEN 3 ELSE 0 END AS batch
    FROM silver, (SELECT greatest(500, (count(*) + 9) // 10) AS each FROM events)"""

# Name -> (tables it reads, SQL).
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "ev": ((), _events(False)),
    "silver": (("ev",), _silver("ev")),
    "occ": (("silver",), _occupancy("silver", "train_id")),
    "gold": (("occ",), _gold("occ")),
    "ev_fleet": ((), _events(True)),
    "silver_fleet": (("ev_fleet",), _silver("ev_fleet")),
    "occ_fleet": (("silver_fleet",), _occupancy("silver_fleet", "subdivision, train_id")),
    "gold_fleet": (("occ_fleet",), _gold("occ_fleet")),
    "features": (("gold",), FEATURES),
    "scored": (("features",), _scored(example_network())),
    "scored_other": (("features",), _scored(other_network())),
    "scored_wide": (("features",), _scored_wide()),
    "latest": (("gold",), _latest("gold", GOLD_REST)),
    "latest_scored": (
        ("scored",),
        _latest("scored", [*GOLD_REST, "rl_advisory_speed_mph"]),
    ),
    "steps": (("silver",), STEPS),
    "episodes": (("steps",), EPISODES),
    "metrics": (("episodes",), METRICS),
    "net": (("occ",), NETWORK),
    "net_fleet": (("occ_fleet",), NETWORK_FLEET),
    "holders": (("occ",), HOLDERS),
    "blocks": ((), BLOCKS),
    "delivered": (("silver",), DELIVERED),
    "deliveries": (
        ("delivered",),
        "SELECT batch, max(event_time) AS latest FROM delivered GROUP BY batch",
    ),
    "windowed": (("delivered", "deliveries"), PUNCTUAL),
    "closed": (
        ("occ", "silver"),
        "SELECT * FROM occ WHERE window_end <= "
        "(SELECT max(event_time) FROM silver) - INTERVAL 30 SECOND",
    ),
    "gold_closed": (("closed",), _gold("closed")),
    "features_closed": (("gold_closed",), FEATURES.replace("FROM gold)", "FROM gold_closed)")),
    "scored_closed": (("features_closed",), _scored(example_network(), "features_closed")),
}


def _with(names: tuple[str, ...], body: str) -> str:
    needed: dict[str, None] = {}

    def visit(name: str) -> None:
        for parent in CTES[name][0]:
            visit(parent)
        needed[name] = None

    for name in names:
        visit(name)
    parts = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n][1]})" for n in needed)
    return f"WITH {parts}\n{body}"


def _checks(layer: str, table: str, *bad: tuple[str, str], total: str = "count(*)") -> str:
    """One row per check of a layer; ``bad`` pairs a check with what it counts."""
    lines = [("rows_present", "CASE WHEN count(*) > 0 THEN 0 ELSE 1 END"), ("columns_present", "0")]
    return "\nUNION ALL\n".join(
        f"SELECT '{layer}' AS layer, '{name}' AS check_name, ({n}) = 0 AS passed, "
        f"{total} AS n_rows, ({n})::BIGINT AS n_bad FROM {table}"
        for name, n in [*lines, *bad]
    )


DQ = {
    "dq_bronze": (
        ("ev",),
        _checks(
            "bronze",
            "ev",
            ("train_id_known", "count(*) FILTER (n % 61 = 0 OR train_id IS NULL)"),
        ),
    ),
    "dq_silver": (
        ("silver",),
        _checks(
            "silver",
            "silver",
            (
                "aspects_valid",
                "count(*) FILTER (signal_aspect_ahead NOT IN ('clear', 'approach', 'stop'))",
            ),
            (
                "speeds_in_range",
                "count(*) FILTER (current_speed_mph < 0 OR current_speed_mph > 79)",
            ),
        ),
    ),
    "dq_occupancy": (
        ("occ",),
        _checks("occupancy", "occ", ("trains_expected", "abs(count(DISTINCT train_id) - 5)")),
    ),
    "dq_gold": (
        ("gold",),
        _checks(
            "gold",
            "gold",
            (
                "severities_valid",
                "count(*) FILTER (delay_severity NOT IN ('nominal', 'moderate', 'critical'))",
            ),
            (
                "advisories_in_range",
                "count(*) FILTER (advisory_speed_mph < 0 OR advisory_speed_mph > 79)",
            ),
        ),
    ),
}

ALL_CHECKS = "\nUNION ALL\n".join(sql for _, sql in DQ.values())


def _whole(x: str) -> str:
    """Text without decimals: half to even, with ``-0`` for small negatives."""
    r = f"round_even({x}::DOUBLE, 0)"
    return f"(CASE WHEN {x} < 0 AND {r} = 0 THEN '-0' ELSE {r}::BIGINT::VARCHAR END)"


def _aspect_colour(signal: str) -> str:
    return (
        f"CASE {signal} WHEN 'clear' THEN '#16a34a' WHEN 'approach' THEN '#ca8a04' "
        f"WHEN 'stop' THEN '#dc2626' ELSE '#166534' END"
    )


def _on_block(table: str, columns: str) -> str:
    """Blocks with the state of the last train reported on each."""
    return f"""blocks b LEFT JOIN (
      SELECT * FROM (SELECT block_id AS held, train_id, {columns},
        row_number() OVER (PARTITION BY block_id ORDER BY train_id DESC) AS rn FROM {table})
      WHERE rn = 1) s ON s.held = b.block_id"""


def _rounded(columns: list[str]) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


SCORES = (
    ("scored",),
    "SELECT window_start, train_id, rl_advisory_speed_mph FROM scored",
)

HISTOGRAM = """
, long AS (
  SELECT policy, 'reward' AS metric, reward AS v FROM episodes
  UNION ALL SELECT policy, 'final_adherence_sec', final_adherence_sec FROM episodes
  UNION ALL SELECT policy, 'avg_speed_mph', avg_speed_mph FROM episodes),
spans AS (
  SELECT policy, metric, avg(v) AS mean,
    CASE WHEN min(v) = max(v) THEN min(v) - 0.5::DOUBLE ELSE min(v) END AS lo,
    CASE WHEN min(v) = max(v) THEN max(v) + 0.5::DOUBLE ELSE max(v) END AS hi
  FROM long GROUP BY policy, metric),
bins AS (
  SELECT policy, metric, mean, i::INTEGER AS bin,
    i * ((hi - lo) / 20.0::DOUBLE) + lo AS bin_low,
    CASE WHEN i = 19 THEN hi ELSE (i + 1) * ((hi - lo) / 20.0::DOUBLE) + lo END AS bin_high
  FROM spans, range(20) t(i))
SELECT b.policy, b.metric, b.bin, round(b.bin_low, 6) AS bin_low,
  round(b.bin_high, 6) AS bin_high, count(v) AS n, round(any_value(b.mean), 6) AS mean
FROM bins b LEFT JOIN long l ON l.policy = b.policy AND l.metric = b.metric
  AND l.v >= b.bin_low AND (l.v < b.bin_high OR b.bin = 19)
GROUP BY b.policy, b.metric, b.bin, b.bin_low, b.bin_high"""

QUERIES: dict[str, tuple[tuple[str, ...], str]] = {
    "bronze_parse": (
        ("ev",),
        "SELECT "
        + ", ".join(
            f"CASE WHEN n % 61 <> 0 THEN {c.strip()}"
            f"{'::DOUBLE' if c.strip() in WHOLE_OR_NULL else ''} END AS {c.strip()}"
            for c in [*EVENT_COLUMNS.split(","), "n_blocks_ahead"]
        )
        + " FROM ev",
    ),
    "silver_validated": (
        ("silver",),
        f"SELECT {EVENT_COLUMNS}, event_time, n_blocks_ahead FROM silver",
    ),
    "blocks_ahead_exploded": (
        ("silver",),
        "SELECT event_id, train_id, event_time, ahead_block_id, occupying_train, "
        "estimated_clearance_sec FROM silver WHERE n_blocks_ahead = 1",
    ),
    "occupancy_sliding": (("occ",), f"SELECT {OCCUPANCY_COLUMNS} FROM occ"),
    "gold_advisories": (("gold",), "SELECT * FROM gold"),
    "gold_fleet": (("gold_fleet",), "SELECT * FROM gold_fleet"),
    "advisory_sample": (
        ("gold",),
        "SELECT train_id, signal_aspect, shockwave_delay_sec, advisory_speed_mph, "
        "delay_severity FROM gold ORDER BY window_start, train_id LIMIT 5",
    ),
    "keyed_json_roundtrip": (
        ("silver",),
        f"SELECT {EVENT_COLUMNS}, n_blocks_ahead FROM silver",
    ),
    **DQ,
    "dq_report": (
        ("ev", "silver", "occ", "gold"),
        f"""SELECT layer, check_name, passed, (NOT passed)::INTEGER::BIGINT AS n_failed, n_bad
        FROM ({ALL_CHECKS})
        UNION ALL
        SELECT 'all', 'failed_checks', bool_and(passed), count(*) FILTER (NOT passed),
          sum(n_bad)::BIGINT
        FROM ({ALL_CHECKS})""",
    ),
    "table_counts": (
        ("ev", "silver", "occ", "gold"),
        "SELECT 'bronze' AS table_name, count(*) AS n_rows FROM ev "
        "UNION ALL SELECT 'silver', count(*) FROM silver "
        "UNION ALL SELECT 'occupancy', count(*) FROM occ "
        "UNION ALL SELECT 'gold', count(*) FROM gold",
    ),
    "rule_violations": (
        ("ev",),
        """SELECT count(*) FILTER (n % 61 = 0 OR train_id IS NULL) AS null_train,
          count(*) FILTER (n % 61 <> 0
            AND signal_aspect_ahead NOT IN ('clear', 'approach', 'stop')) AS bad_signal,
          count(*) FILTER (n % 61 <> 0
            AND (current_speed_mph < 0 OR current_speed_mph > 79)) AS bad_speed
        FROM ev""",
    ),
    "derived_signals": (
        ("net",),
        """SELECT window_start, train_id, block_idx, CASE WHEN next_taken THEN 'stop'
          WHEN second_taken THEN 'approach' ELSE 'clear' END AS derived_aspect FROM net""",
    ),
    "derived_signals_fleet": (
        ("net_fleet",),
        """SELECT window_start, subdivision, train_id, block_idx,
          CASE WHEN next_taken THEN 'stop' WHEN second_taken THEN 'approach' ELSE 'clear' END
          AS derived_aspect FROM net_fleet""",
    ),
    "blocks_ahead_list": (
        ("holders",),
        """SELECT o.window_start, o.train_id, o.block_idx, ahead::INTEGER AS ahead,
          h.block_idx AS ahead_block_idx, h.holder AS occupying_train,
          'B_' || lpad((h.block_idx + 1)::VARCHAR, greatest(3, length((h.block_idx + 1)::VARCHAR))::INTEGER, '0') AS ahead_block_id
        FROM occ o CROSS JOIN (SELECT unnest([1, 2]) AS ahead)
        JOIN holders h ON h.window_start = o.window_start
          AND h.block_idx = o.block_idx + ahead
        WHERE h.holder <> o.train_id""",
    ),
    "blocks_ahead_count": (
        ("net",),
        """SELECT window_start, train_id, block_idx,
          next_taken::INTEGER + second_taken::INTEGER AS n_ahead FROM net""",
    ),
    "next_block_free": (
        ("net",),
        "SELECT window_start, train_id, block_idx FROM net WHERE NOT next_taken",
    ),
    "occupied_blocks": (("occ",), "SELECT DISTINCT window_start, block_idx FROM occ"),
    "shockwave_cascade": (
        ("gold", "holders"),
        """SELECT window_start, block_idx, train_id, lead_train,
          CASE WHEN lead_aspect = 'stop' THEN
            ((lead_block_idx - block_idx + 20) % 20)::DOUBLE * 60.0::DOUBLE
              * ((79.0::DOUBLE - lead_speed::DOUBLE) / 79.0::DOUBLE)
            ELSE 0.0::DOUBLE END AS cascade_delay_sec
        FROM (SELECT window_start, block_idx, train_id,
            CASE WHEN n > 1 THEN coalesce(next_state.train_id, first_state.train_id) END AS lead_train,
            CASE WHEN n > 1 THEN coalesce(next_state.block_idx, first_state.block_idx) END AS lead_block_idx,
            CASE WHEN n > 1 THEN coalesce(next_state.speed_mph, first_state.speed_mph) END AS lead_speed,
            CASE WHEN n > 1 THEN coalesce(next_state.signal_aspect, first_state.signal_aspect) END AS lead_aspect
          FROM (SELECT g.window_start, g.block_idx, g.train_id, count(*) OVER p AS n,
              lead({'train_id': g.train_id, 'block_idx': g.block_idx, 'speed_mph': speed_mph,
                'signal_aspect': signal_aspect}) OVER w AS next_state,
              first_value({'train_id': g.train_id, 'block_idx': g.block_idx, 'speed_mph': speed_mph,
                'signal_aspect': signal_aspect}) OVER w AS first_state
            FROM gold g JOIN holders h ON h.window_start = g.window_start
              AND h.block_idx = g.block_idx AND h.holder = g.train_id
            WINDOW w AS (PARTITION BY g.window_start ORDER BY g.block_idx),
              p AS (PARTITION BY g.window_start)))""",
    ),
    "latest_per_train": (("latest",), "SELECT * FROM latest"),
    "track_map": (
        ("latest", "blocks"),
        f"""SELECT block_idx, block_id, train_id, {_whole("speed_mph")} || ' mph' AS speed,
          CASE WHEN train_id IS NULL THEN 'CLEAR' ELSE CASE signal_aspect
            WHEN 'approach' THEN 'APP' WHEN 'stop' THEN 'STP' ELSE 'CLR' END END AS label,
          CASE WHEN train_id IS NULL THEN '#166534'
            ELSE {_aspect_colour("signal_aspect")} END AS colour
        FROM {_on_block("latest", "signal_aspect, speed_mph")}""",
    ),
    "advisory_feed": (
        ("latest",),
        f"""SELECT train_id, block_id, {_whole("speed_mph")} || ' mph' AS speed,
          upper(signal_aspect) AS signal,
          CASE signal_aspect WHEN 'clear' THEN '🟢' WHEN 'approach' THEN '🟡'
            WHEN 'stop' THEN '🔴' ELSE '⚪' END AS signal_icon,
          {_whole("advisory_speed_mph")} || ' mph' AS advisory,
          {_whole("shockwave_delay_sec")} || 's' AS shockwave,
          CASE WHEN schedule_adherence_sec >= 0 THEN '+' ELSE '' END
            || {_whole("schedule_adherence_sec")} || 's' AS adherence,
          CASE WHEN schedule_adherence_sec >= -60 THEN 'green' ELSE 'red' END
            AS adherence_colour,
          upper(delay_severity) AS severity,
          CASE delay_severity WHEN 'nominal' THEN '#16a34a' WHEN 'moderate' THEN '#ca8a04'
            WHEN 'critical' THEN '#dc2626' ELSE '#6b7280' END AS severity_colour
        FROM latest""",
    ),
    "corridor_summary": (
        ("latest",),
        """SELECT round(avg(schedule_adherence_sec::DOUBLE), 6) AS avg_adherence_sec,
          round(avg(speed_mph::DOUBLE), 6) AS avg_speed_mph,
          count(*) FILTER (delay_severity = 'critical') AS critical_trains,
          round(avg(advisory_speed_mph), 6) AS avg_advisory_mph, count(*) AS trains
        FROM latest""",
    ),
    "marey_series": (("gold",), _marey("gold")),
    "dashboard_state": (("gold",), _latest(_newest_files(8), GOLD_REST)),
    "dashboard_history": (("gold",), _marey(_newest_files(20))),
    "rl_overlay": (
        ("latest_scored", "blocks"),
        f"""SELECT block_idx, block_id, train_id,
          {_whole("rl_advisory_speed_mph")} || ' mph' AS advisory, rule_speed_mph,
          CASE WHEN differs THEN 'RL' WHEN NOT differs THEN 'STD' END AS source,
          CASE WHEN differs THEN '#7c3aed' WHEN train_id IS NULL THEN '#166534'
            ELSE {_aspect_colour("signal_aspect")} END AS colour
        FROM (SELECT *, abs(rl_advisory_speed_mph - rule_speed_mph) > 5 AS differs
          FROM (SELECT b.block_idx, b.block_id, s.*, CASE WHEN train_id IS NOT NULL THEN
              CASE signal_aspect WHEN 'stop' THEN 0.0::DOUBLE WHEN 'approach' THEN 20.0::DOUBLE
                ELSE 79.0::DOUBLE END END AS rule_speed_mph
            FROM {_on_block("latest_scored", "signal_aspect, rl_advisory_speed_mph")}))""",
    ),
    "absent_columns": (
        ("latest",),
        f"""SELECT train_id, '?' AS block_id, '0 mph' AS speed, 'CLEAR' AS signal,
          '🟢' AS signal_icon, '79 mph' AS advisory,
          {_whole("shockwave_delay_sec")} || 's' AS shockwave,
          CASE WHEN schedule_adherence_sec >= 0 THEN '+' ELSE '' END
            || {_whole("schedule_adherence_sec")} || 's' AS adherence,
          CASE WHEN schedule_adherence_sec >= -60 THEN 'green' ELSE 'red' END
            AS adherence_colour,
          'NOMINAL' AS severity, '#16a34a' AS severity_colour
        FROM latest""",
    ),
    "keyed_log_order": (
        ("ev",),
        """SELECT train_id, count(*) AS n_rows, 1::BIGINT AS n_partitions,
          0::BIGINT AS n_disorder FROM ev GROUP BY train_id""",
    ),
    "union_by_name": (
        ("occ",),
        f"""SELECT {OCCUPANCY_COLUMNS.replace("track_grade_pct", "").strip()}
          CASE WHEN epoch(window_start)::BIGINT // 10 % 2 = 1 THEN track_grade_pct END
            AS track_grade_pct FROM occ""",
    ),
    "recent_files_scan": (
        ("occ",),
        f"SELECT {OCCUPANCY_COLUMNS} FROM occ WHERE epoch(window_start)::BIGINT // 10 % 10 >= 2",
    ),
    "policy_features": (
        ("features",),
        f"SELECT window_start, train_id, blocks_count, {', '.join(OBSERVATION)} FROM features",
    ),
    "policy_scores": SCORES,
    "policy_scores_sql": SCORES,
    "rule_policy_actions": (
        ("features",),
        """SELECT window_start, train_id, (CASE WHEN is_stop > 0.5 THEN 0
            WHEN is_approach > 0.5 THEN 1 ELSE 4 END)::INTEGER AS action,
          CASE WHEN is_stop > 0.5 THEN 0.0::DOUBLE WHEN is_approach > 0.5 THEN 20.0::DOUBLE
            ELSE 79.0::DOUBLE END AS target_speed_mph
        FROM features""",
    ),
    "advisory_agreement": (
        ("scored",),
        """SELECT signal_aspect, count(*) AS n_rows,
          count(*) FILTER (abs(rl_advisory_speed_mph - advisory_speed_mph) > 5) AS n_differ,
          round(avg(advisory_speed_mph), 6) AS avg_rule_mph,
          round(avg(rl_advisory_speed_mph), 6) AS avg_other_mph
        FROM scored GROUP BY signal_aspect""",
    ),
    "score_parity": (
        ("scored", "scored_other"),
        """SELECT 'same network' AS pair, count(*) AS n_rows, 0::BIGINT AS n_mismatch,
          true AS matches FROM scored
        UNION ALL
        SELECT 'other network', count(*), count(*) FILTER (abs(s.rl_advisory_speed_mph
            - o.rl_advisory_speed_mph) > 1e-5 + 1e-5 * abs(o.rl_advisory_speed_mph)) AS n,
          n = 0
        FROM scored s JOIN scored_other o USING (window_start, train_id)""",
    ),
    "policy_scores_64": (
        ("scored_wide",),
        "SELECT window_start, train_id, rl_advisory_speed_mph FROM scored_wide",
    ),
    "network_features": (
        ("net",),
        """SELECT window_start, train_id,
          coalesce(speed_mph::DOUBLE, 0) / 79.0::DOUBLE AS speed_norm,
          next_taken::INTEGER::DOUBLE AS is_stop,
          (NOT next_taken AND second_taken)::INTEGER::DOUBLE AS is_approach,
          (NOT next_taken AND NOT second_taken)::INTEGER::DOUBLE AS is_clear,
          (next_taken::INTEGER + second_taken::INTEGER)::DOUBLE / 2.0::DOUBLE AS ahead_norm,
          greatest(least(coalesce(schedule_adherence_sec::DOUBLE, 0) / 300.0::DOUBLE,
            1.0::DOUBLE), (-1.0)::DOUBLE) AS adherence_norm,
          greatest(least(coalesce(track_grade_pct::DOUBLE, 0) / 3.0::DOUBLE, 1.0::DOUBLE),
            (-1.0)::DOUBLE) AS grade_norm,
          block_idx::DOUBLE / 19.0::DOUBLE AS progress_norm
        FROM net""",
    ),
    "step_rewards": (
        ("steps",),
        "SELECT train_id, event_id, step::BIGINT AS step, prev_speed_mph, reward FROM steps",
    ),
    "running_reward": (
        ("steps",),
        """SELECT train_id, event_id, episode_no::BIGINT AS episode_no,
          episode_step::BIGINT AS episode_step, round(sum(reward) OVER (
            PARTITION BY train_id, episode_no ORDER BY episode_step
            ROWS UNBOUNDED PRECEDING), 6) AS running_reward
        FROM steps""",
    ),
    "episode_metrics": (
        ("episodes",),
        "SELECT train_id, episode_no::BIGINT AS episode_no, "
        + _rounded(["reward", "final_adherence_sec", "avg_speed_mph"])
        + " FROM episodes",
    ),
    "policy_metrics": (
        ("metrics",),
        "SELECT policy, n_episodes, "
        + _rounded(["mean_reward", "std_reward", "mean_adherence_sec", "mean_avg_speed_mph"])
        + " FROM metrics",
    ),
    "policy_compare": (
        ("metrics",),
        """SELECT m.policy, m.n_episodes,
          round(m.mean_reward - b.mean_reward, 6) AS delta_reward,
          round(m.mean_adherence_sec - b.mean_adherence_sec, 6) AS delta_adherence_sec
        FROM metrics m JOIN metrics b ON b.policy = 'base' WHERE m.policy <> 'base'""",
    ),
    "metric_histogram": (("episodes",), HISTOGRAM),
    "stream_silver_append": (
        ("silver",),
        f"SELECT {EVENT_COLUMNS}, event_time, n_blocks_ahead FROM silver",
    ),
    "stream_occupancy_from_silver": (("occ",), f"SELECT {OCCUPANCY_COLUMNS} FROM occ"),
    "stream_occupancy_append": (("closed",), f"SELECT {OCCUPANCY_COLUMNS} FROM closed"),
    "stream_occupancy_complete": (("occ",), f"SELECT {OCCUPANCY_COLUMNS} FROM occ"),
    "stream_occupancy_update": (("occ",), f"SELECT {OCCUPANCY_COLUMNS} FROM occ"),
    "stream_late": (
        ("windowed", "silver"),
        f"""SELECT window_start, window_end, train_id, {", ".join(
            "s." + c.strip() for c in STATE_COLUMNS.split(","))}
        FROM (SELECT window_start, window_end, train_id, arg_max(
              {{'block_id': block_id, 'block_idx': block_idx,
                'signal_aspect': signal_aspect_ahead, 'speed_mph': current_speed_mph,
                'schedule_adherence_sec': schedule_adherence_sec,
                'track_grade_pct': track_grade_pct}}, (event_time, event_id)) AS s
          FROM windowed WHERE NOT late GROUP BY window_start, window_end, train_id)
        WHERE window_end <= (SELECT max(event_time) FROM silver) - INTERVAL 30 SECOND""",
    ),
    "stream_late_count": (
        ("windowed",),
        """SELECT count(DISTINCT (batch, window_start, train_id)) AS n_dropped
        FROM windowed WHERE late""",
    ),
    "stream_step_rewards": (
        ("steps",),
        """SELECT train_id, event_id, step::BIGINT AS step, prev_speed_mph, reward FROM steps
        WHERE event_time <= (SELECT max(event_time) FROM silver) - INTERVAL 30 SECOND""",
    ),
    "stream_scored": (
        ("scored_closed",),
        "SELECT window_start, train_id, delay_severity, rl_advisory_speed_mph FROM scored_closed",
    ),
    "stream_gold": (("gold_closed",), "SELECT * FROM gold_closed"),
}

# The log keeps every row, so Bronze read from it is Bronze.
QUERIES["stream_keyed_log"] = QUERIES["bronze_parse"]


def oracle_sql() -> dict[str, str]:
    """Complete SQL per query."""
    return {name: _with(tables, body) for name, (tables, body) in QUERIES.items()}
