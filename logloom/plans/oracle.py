"""The derived tables of `views`, stated in SQL."""

TAG_RE = r"kubernetes\.var\.log\.containers\.([^_]+)_([^_]+)_(.+)-([a-z0-9]{64})\.log$"

LOGS = r"""
base AS (
  SELECT event_id AS eid, CAST(event_id AS VARCHAR) AS record_id, ts, event_type, value, props,
    user_id, sha256(CAST(event_id AS VARCHAR)) AS digest, 'pod-' || (user_id % 10) AS pod,
    CASE WHEN user_id % 5 = 0 THEN 'garden'
         ELSE 'shoot--p' || (user_id % 3) || '--c' || (user_id % 20) END AS ns
  FROM events),
logs AS (
  SELECT *, eid % 200 = 3 AS is_empty, eid % 2 = 1 AND eid % 200 <> 3 AS has_k8s,
    CASE WHEN eid % 97 = 0 THEN NULL
         ELSE 'kubernetes.var.log.containers.' || pod || '_' || ns
              || CASE WHEN eid % 50 = 0 THEN '-' ELSE '_' END
              || event_type || '-' || digest || '.log' END AS tag,
    CASE WHEN eid % 3 = 0 THEN '' ELSE 'uid-' || eid END AS pod_id,
    'node-' || (user_id % 7) AS node,
    'id: "' || eid || '" value ' || value AS log_text
  FROM base),
meta AS (
  SELECT *, NOT has_k8s AND NOT coalesce(regexp_matches(rtag, 'TAGRE'), FALSE) AS failed
  FROM (SELECT *, CASE WHEN is_empty THEN NULL ELSE tag END AS rtag FROM logs)),
hosted AS (
  SELECT *, coalesce(starts_with(found, 'shoot-'), FALSE) AS dynamic,
    CASE WHEN starts_with(found, 'shoot-') THEN found ELSE 'garden' END AS host
  FROM (SELECT *, CASE WHEN has_k8s THEN ns
                       WHEN NOT failed THEN regexp_extract(rtag, 'TAGRE', 2) END AS found
        FROM meta)),
leveled AS (
  SELECT *,
    CASE WHEN is_empty THEN 9 ELSE CASE event_type WHEN 'error' THEN 17 WHEN 'click' THEN 5
      WHEN 'view' THEN 9 WHEN 'signup' THEN 13 ELSE 9 END END AS severity_number,
    CASE WHEN is_empty THEN 'Info' ELSE CASE event_type WHEN 'error' THEN 'ERR'
      WHEN 'click' THEN 'dbg' WHEN 'view' THEN 'info' WHEN 'signup' THEN '4'
      ELSE 'Info' END END AS severity_text
  FROM hosted)
""".replace("TAGRE", TAG_RE).strip()

CHANGES = r"""
changes AS (
  SELECT event_id AS seq, ts, event_id % 12 AS kase, event_id % 17 = 0 AS malformed,
    CASE WHEN event_id % 13 = 0 THEN 'delete' ELSE 'update' END AS op,
    event_id % 29 = 0 AS going, event_id % 11 = 0 AS testing,
    CASE WHEN user_id % 5 = 0 THEN 'garden'
         ELSE 'shoot--p' || (user_id % 3) || '--c' || (user_id % 20) END AS name
  FROM events WHERE event_type IN ('signup', 'purchase')),
classified AS (
  SELECT *,
    CASE WHEN malformed THEN NULL WHEN kase IN (0, 10) THEN 'creation' WHEN kase = 1 THEN 'ready'
      WHEN kase = 2 THEN 'hibernating' WHEN kase = 3 THEN 'hibernated' WHEN kase = 4 THEN 'waking'
      WHEN kase = 5 THEN 'deletion' WHEN kase IN (6, 7) THEN 'migration'
      WHEN kase IN (8, 9) THEN 'restore' END AS state,
    CASE WHEN op = 'delete' THEN 'remove' WHEN malformed THEN 'ignore' WHEN going THEN 'remove'
      WHEN kase = 11 THEN 'ignore' WHEN testing OR kase = 5 THEN 'remove' ELSE 'keep' END AS action
  FROM changes),
effective AS (SELECT * FROM classified WHERE action <> 'ignore'),
latest AS (
  SELECT name AS host, arg_max(action, seq) AS action, arg_max(state, seq) AS state
  FROM effective GROUP BY name),
routes AS (
  SELECT host, state, state NOT IN ('hibernating', 'hibernated') AS to_shoot,
    state IN ('creation', 'deletion', 'deleted', 'restore', 'migration') AS to_seed,
    'collector.' || host || '.svc.cluster.local:4317' AS endpoint
  FROM latest WHERE action = 'keep'),
history AS (
  SELECT name AS host, ts AS valid_from, valid_to, state,
    state NOT IN ('hibernating', 'hibernated') AS to_shoot,
    state IN ('creation', 'deletion', 'deleted', 'restore', 'migration') AS to_seed,
    'collector.' || name || '.svc.cluster.local:4317' AS endpoint
  FROM (SELECT *, lead(ts) OVER (PARTITION BY name ORDER BY ts, seq) AS valid_to FROM effective)
  WHERE action = 'keep' AND (valid_to IS NULL OR valid_to > ts))
""".strip()

LEDGER = r"""
ledger AS (
  SELECT l.*, r.endpoint, r.to_shoot, r.to_seed,
    CASE WHEN failed THEN 'dropped_no_metadata'
      WHEN is_empty THEN 'dropped_empty'
      WHEN NOT dynamic THEN 'routed'
      WHEN r.host IS NULL THEN 'dropped_no_client'
      WHEN NOT r.to_shoot AND NOT r.to_seed THEN 'muted' ELSE 'routed' END AS disposition
  FROM leveled l LEFT JOIN routes r ON l.host = r.host),
sent AS (
  SELECT record_id, ts, host, 'SEED' AS target, 'collector-seed.svc.cluster.local:4317' AS endpoint
  FROM ledger WHERE disposition = 'routed' AND (NOT dynamic OR to_seed)
  UNION ALL
  SELECT record_id, ts, host, 'SHOOT', endpoint
  FROM ledger WHERE disposition = 'routed' AND dynamic AND to_shoot)
""".strip()

SAMPLES = r"""
samples AS (
  SELECT series, ts, sum(n) OVER (PARTITION BY series, floor(epoch(ts) / 360000)
                                  ORDER BY ts) AS value
  FROM (SELECT event_type AS series, date_trunc('hour', ts) AS ts, CAST(count(*) AS DOUBLE) AS n
        FROM events GROUP BY ALL)),
gauge AS (SELECT event_type AS series, ts, value, event_id AS seq FROM events)
""".strip()

KUBE_EVENTS = r"""
kube AS (
  SELECT *, CASE o_orderkey % 3 WHEN 0 THEN 'kube-system' WHEN 1 THEN 'default'
                 ELSE 'other' END AS namespace
  FROM orders WHERE o_orderkey % 10 <= 5),
feed AS (
  SELECT 'seed' AS origin, * FROM kube WHERE namespace = 'kube-system'
  UNION ALL
  SELECT 'shoot', * FROM kube WHERE namespace IN ('kube-system', 'default')),
shown AS (
  SELECT origin, namespace,
    CASE WHEN o_orderpriority LIKE '1%' THEN 'Warning' ELSE 'Normal' END AS type,
    CAST(nullif(o_orderkey % 4, 0) AS INTEGER) AS count,
    CASE WHEN o_orderkey % 6 = 0 THEN o_orderdate END AS "eventTime",
    o_orderdate AS "firstTimestamp",
    CASE WHEN o_orderkey % 5 <> 0
         THEN o_orderdate + to_seconds(o_orderkey % 10) END AS "lastTimestamp",
    nullif(substr(o_orderpriority, 3), '') AS reason,
    CASE o_orderstatus WHEN 'O' THEN 'Pod/' WHEN 'F' THEN 'Node/' ELSE '' END
      || 'obj-' || o_orderkey AS object,
    CASE WHEN o_orderkey % 4 <> 0 THEN 'order ' || o_orderkey END AS _entry,
    'kubelet' AS source,
    CASE WHEN o_orderkey % 2 = 0 THEN 'node-' || (o_custkey % 9) END AS "sourceHost"
  FROM feed)
""".strip()


def sql(body: str, *tables: str) -> str:
    return "WITH " + ",\n".join(tables) + "\n" + body.strip() if tables else body.strip()
