"""The named queries in DuckDB SQL, written from the definitions of the results."""

from __future__ import annotations

ISO = "'%Y-%m-%dT%H:%M:%S.%gZ'"


def iso(micros: str) -> str:
    return f"strftime(make_timestamp(CAST({micros} AS BIGINT)), {ISO})"


def iso_micros(stamp: str) -> str:
    return f"strftime({stamp}, '%Y-%m-%dT%H:%M:%S.%fZ')"


def seconds(text: str) -> str:
    """Epoch seconds of ISO text, halves up."""
    return f"(epoch_us(CAST({text} AS timestamptz)) + 500000) // 1000000"


def least(seconds_: str, floor: int) -> str:
    return f"CASE WHEN {seconds_} < {floor} THEN {floor} ELSE {seconds_} END"


def as_int(expression: str) -> str:
    return f"CAST({expression} AS INTEGER)"


# Contacts. -----------------------------------------------------------------------

CONTACTS = f"""
o1 AS (SELECT *, epoch_us(o_orderdate) + (o_orderkey % 86400) * 1000000 AS i_us FROM orders),
o2 AS (SELECT *, i_us + (o_custkey % 7) * 1000000 AS y_us FROM o1),
o3 AS (SELECT *, y_us + (o_orderkey * 7919 % 180) * 1000000 + (o_orderkey % 4) * 250000 AS d_us FROM o2),
ct AS (
  SELECT o_orderkey, o_custkey, o_orderpriority, 'account-' || (o_custkey % 3) AS account_id,
    'instance-1' AS instance,
    CASE WHEN o_orderkey % 4 = 0 THEN 'CHAT' ELSE 'VOICE' END AS channel,
    o_orderpriority AS queue,
    '+1800' || (o_custkey % 10) AS system_address,
    'c' || o_orderkey AS contact_id,
    CASE WHEN o_orderkey % 3 <> 0 THEN 'c' || (o_orderkey - o_orderkey % 3) END AS initial_contact_id,
    '+1555' || o_custkey AS customer_address,
    'agent-' || (o_custkey % 50) AS agent,
    CASE WHEN o_orderstatus = 'P' THEN '{{"Address":"+1777' || o_custkey || '"}}' END AS transfer_endpoint,
    CASE left(o_orderpriority, 1) WHEN '1' THEN 'CALLBACK' WHEN '2' THEN 'OUTBOUND' WHEN '3' THEN 'TRANSFER'
      WHEN '4' THEN 'INBOUND' END AS method,
    {iso('i_us')} AS initiated,
    {iso('y_us + 2000000')} AS agent_connected,
    {iso('d_us')} AS disconnected,
    {iso('y_us')} AS system_connected,
    CASE WHEN o_orderstatus = 'P' THEN {iso('y_us + 30000000')} END AS transferred,
    {iso('d_us + 60000000')} AS last_update
  FROM o3),
cs AS (
  SELECT *, {seconds('disconnected')} - {seconds('initiated')} AS init_disc,
    {seconds('disconnected')} - {seconds('system_connected')} AS sys_disc,
    {seconds('disconnected')} - {seconds('transferred')} AS xfer_disc
  FROM ct)"""

R1_METRICS = """
r1 AS (SELECT *,
  CASE WHEN method IS NULL THEN NULL WHEN method = 'CALLBACK' THEN sys_disc ELSE init_disc END AS service,
  xfer_disc AS third, sys_disc AS customer FROM cs)"""

# Legs. -----------------------------------------------------------------------------

LEGS = f"""
l1 AS (SELECT *, 'c' || l_orderkey AS contact_id, epoch_us(l_shipdate) AS k,
    NOT (l_discount = 0 AND l_tax = 0) AS has_leg FROM lineitem),
l2 AS (SELECT *, contact_id || CASE WHEN l_linenumber = 1 THEN '' ELSE '-' || l_linenumber END AS conn_id,
    CASE WHEN l_discount <> 0 THEN k + l_linenumber * 1000000 END AS con_us,
    CASE WHEN l_tax <> 0 THEN k + l_linenumber * 1000000 + CAST(l_quantity * 2500000 AS BIGINT) END AS dis_us,
    CASE l_returnflag WHEN 'A' THEN 'agent' WHEN 'R' THEN 'outbound' ELSE 'inbound' END AS type,
    CASE WHEN l_returnflag = 'A' THEN '+44' || (2000000 + l_partkey) END AS extension,
    CASE WHEN l_returnflag = 'A' THEN l_linestatus = 'O' END AS softphone,
    CASE WHEN l_partkey % 13 = 0 THEN 'anonymous' WHEN l_returnflag = 'R' THEN '+49' || (3000000 + l_partkey)
      WHEN l_linenumber % 2 = 0 THEN '+1204' || (1000000 + l_partkey)
      ELSE '+1555' || (1000000 + l_partkey) END AS number,
    CASE WHEN l_linenumber = 3 THEN NULL WHEN l_returnflag = 'A' THEN 'GB' WHEN l_returnflag = 'R' THEN 'DE'
      ELSE 'US' END AS country,
    CASE WHEN l_linenumber = 7 THEN '' WHEN l_returnflag = 'N' THEN 'true' ELSE 'false' END AS inbound_text,
    CASE WHEN l_linenumber % 2 = 1 THEN contact_id END AS initial_connection
  FROM l1),
l3 AS (SELECT *, {iso('k')} AS connecting, {iso('con_us')} AS connected, {iso('dis_us')} AS dropped,
    (l_linenumber = 6 AND l_tax = 0) AS lost FROM l2),
legs AS (
  SELECT contact_id, conn_id, inbound_text, initial_connection, type, extension, softphone, number, country,
    connecting, connected, dropped, 0 AS older, lost, l_linenumber,
    CASE WHEN lost THEN NULL WHEN l_linenumber <> 5 THEN connecting
      ELSE coalesce(connected, dropped) END AS history_start
  FROM l3 WHERE has_leg
  UNION ALL
  SELECT contact_id, conn_id, inbound_text, initial_connection, NULL, NULL, NULL, NULL, NULL,
    {iso('k + 1000000')}, NULL, NULL, 1, false, l_linenumber, connecting
  FROM l3 WHERE has_leg AND l_suppkey % 2 = 1),
merged AS (
  SELECT contact_id, conn_id, min(history_start) AS first_seen, min(type) AS type, min(extension) AS extension,
    'phone_number' AS endpoint_type, min(number) AS number, bool_and(softphone) AS softphone,
    bool_or(CASE inbound_text WHEN 'true' THEN true WHEN 'false' THEN false END) AS inbound,
    min(initial_connection) AS initial_connection, min(connecting) AS connecting, min(connected) AS connected,
    min(dropped) AS dropped, min(country) AS country
  FROM legs GROUP BY contact_id, conn_id)"""

CONNECTION_ROWS = f""",
staged AS (SELECT *, '{{"part":' || l_partkey || '}}|q' || (l_suppkey % 10) || '|' AS head FROM l3),
connection_rows AS (
  SELECT contact_id AS "contactId", inbound_text AS inbound, initial_connection AS "initialConnectionId",
    connecting AS "initialTimestamp", 'voice' AS type,
    CASE WHEN has_leg THEN 1 + l_suppkey % 2 WHEN l_suppkey % 2 = 0 THEN 0 ELSE -1 END AS legs, CAST(n AS INTEGER) AS at,
    CASE WHEN has_leg THEN conn_id END AS leg_id, CASE WHEN n = 0 THEN staged.type END AS leg_type,
    CASE WHEN n = 1 THEN 'connecting' WHEN n = 0 AND dis_us IS NULL THEN 'connected' WHEN n = 0 THEN 'disconnected' END AS status,
    CASE WHEN n = 1 THEN connecting WHEN n = 0 THEN coalesce(dropped, connected, connecting) END AS updated,
    CASE WHEN n = 1 THEN {iso('k + 1000000')} WHEN n = 0 THEN connecting END AS connecting,
    CASE WHEN n = 0 THEN connected END AS connected, CASE WHEN n = 0 THEN dropped END AS disconnected,
    CASE WHEN n = 0 THEN CAST(softphone AS INTEGER) END AS softphone, CASE WHEN n = 0 THEN extension END AS extension,
    CASE WHEN n = 0 THEN number END AS number, CASE WHEN n = 0 THEN country END AS country,
    CASE WHEN n = 1 THEN 'connecting' WHEN n = 0 THEN concat_ws(',', CASE WHEN l_linenumber <> 5 THEN 'connecting' END,
      CASE WHEN con_us IS NOT NULL THEN 'connected' END, CASE WHEN dis_us IS NOT NULL THEN 'disconnected' END,
      CASE WHEN lost THEN 'lost' END) END AS history,
    head || CASE WHEN l_linenumber > 1 THEN conn_id ELSE '' END || '|' || connecting || '|connecting' AS "stageConnecting",
    head || '|' || connected || '|connected' AS "stageConnected", head || '|' || dropped || '|ended' AS "stageEnded",
    CASE WHEN lost THEN head || '|' || connecting || '|error' END AS "stageError"
  FROM staged JOIN (VALUES (0), (1), (NULL)) t(n) ON CASE WHEN has_leg THEN n <= l_suppkey % 2 ELSE n IS NULL END)"""

VOICE = f"""
vl AS (
  SELECT v.*, m.conn_id AS leg_id, m.type AS leg_type, m.extension, m.softphone, m.inbound, m.initial_connection,
    m.connecting, m.connected, m.dropped, m.country,
    {seconds('m.dropped')} - {seconds('m.connected')} AS leg_seconds,
    coalesce(m.conn_id = v.contact_id, false) AS own,
    coalesce(m.conn_id = v.contact_id, false) OR (m.conn_id IS NULL AND v.initial_contact_id IS NULL) AS mine
  FROM (SELECT * FROM cs WHERE channel = 'VOICE') v LEFT JOIN merged m ON m.contact_id = v.contact_id),
r2 AS (SELECT *,
    CASE WHEN method = 'CALLBACK' AND own THEN sys_disc WHEN method <> 'CALLBACK' AND mine THEN init_disc END AS service,
    CASE WHEN leg_type = 'agent' AND NOT softphone THEN leg_seconds END AS desk,
    CASE WHEN leg_type IN ('inbound', 'outbound') AND NOT own
      THEN CASE WHEN dropped IS NULL THEN xfer_disc ELSE leg_seconds END END AS third,
    CASE WHEN mine THEN sys_disc END AS customer
  FROM vl)"""

# Chats. -----------------------------------------------------------------------------

DOCUMENTS = """
d1 AS (SELECT conv_id, turn, role, 'c' || ((conv_id * 8 + turn) * 2) AS contact_id,
    CASE WHEN turn % 7 <> 6 THEN string_split(text, chr(10)) ELSE [] END AS lines FROM conversations),
d2 AS (SELECT conv_id, turn, role, contact_id, unnest(range(len(lines))) AS i FROM d1),
items AS (SELECT *, CASE WHEN (turn + i) % 5 = 4 THEN 'EVENT' ELSE 'MESSAGE' END AS type,
    CASE WHEN i % 4 = 3 THEN 'SUPERVISOR' WHEN i % 4 = 0 AND role = 'user' THEN 'CUSTOMER'
      WHEN i % 4 = 1 AND role = 'assistant' THEN 'CUSTOMER' WHEN i % 4 = 2 THEN 'SYSTEM'
      WHEN role = 'system' THEN 'SYSTEM' ELSE 'AGENT' END AS speaker FROM d2),
counted AS (SELECT conv_id, turn, count(*) FILTER (type = 'MESSAGE' AND speaker = 'SYSTEM') AS s,
    count(*) FILTER (type = 'MESSAGE' AND speaker = 'CUSTOMER') AS c,
    count(*) FILTER (type = 'MESSAGE' AND speaker = 'AGENT') AS a FROM items GROUP BY conv_id, turn),
docs AS (SELECT d1.contact_id AS "contactId", 'instance-1' AS "instanceId", CAST(coalesce(s, 0) AS INTEGER) AS system_msg,
    CAST(coalesce(c, 0) AS INTEGER) AS customer_msg, CAST(coalesce(a, 0) AS INTEGER) AS agent_msg,
    CAST(coalesce(s + c + a, 0) AS INTEGER) AS total_msg FROM d1 LEFT JOIN counted USING (conv_id, turn))"""

CHATS = """
chats AS (SELECT 'c' || (conv_id * 2) AS contact_id,
    count(*) FILTER (role = 'system') AS s, count(*) FILTER (role = 'user') AS c,
    count(*) FILTER (role = 'assistant') AS a FROM (
      SELECT conv_id, CASE WHEN turn % 5 <> 4 THEN role END AS role FROM conversations) GROUP BY conv_id),
r3 AS (SELECT 'instance-1' AS instanceid, queue AS name, contact_id AS "ContactId", channel,
    initiated AS "CallInitiationTimestamp", agent_connected AS "ConnectedToAgentTimestamp",
    disconnected AS "DisconnectTimestamp", system_connected AS "ConnectedToSystemTimestamp",
    CAST(s AS INTEGER) AS "ChatUsageSystemMsg", CAST(c AS INTEGER) AS "ChatUsageCustomerMsg",
    CAST(a AS INTEGER) AS "ChatUsageAgentMsg", CAST(s + c + a AS INTEGER) AS "ChatUsageTotalMsg"
  FROM chats JOIN ct USING (contact_id) WHERE channel = 'CHAT')"""

# Call events. ---------------------------------------------------------------------------

EVENTS = """
e1 AS (SELECT 'u' || user_id || '-' || ((day(ts) - 1) // 3) AS contact, event_id, user_id, ts, event_type AS source,
    props, CAST(epoch_us(ts) AS HUGEINT) * 1000000000 + event_id AS ord FROM events),
ev AS (SELECT *,
    CASE source WHEN 'signup' THEN 'Connecting' WHEN 'view' THEN 'Connected' WHEN 'click' THEN 'ACW'
      WHEN 'purchase' THEN 'Destroyed' ELSE 'Refresh' END AS kind,
    CASE WHEN source = 'signup' THEN 'connecting' WHEN source = 'view' THEN 'connected'
      WHEN source IN ('click', 'purchase') THEN 'ended' WHEN event_id % 5 = 0 THEN 'error' ELSE 'connected' END AS status,
    CASE event_id % 4 WHEN 2 THEN 'voice' WHEN 3 THEN 'queue_callback' END AS contact_type,
    CASE WHEN event_id % 11 <> 0 THEN event_id % 3 = 0 END AS inbound,
    CASE WHEN event_id % 5 <> 0 THEN 'k' || (event_id % 2) END AS initial_connection,
    'k' || (event_id % 2) AS conn,
    CASE WHEN event_id % 2 = 0 THEN 'agent' WHEN event_id % 8 < 4 THEN 'outbound' ELSE 'inbound' END AS conn_type,
    CASE source WHEN 'signup' THEN 'connecting' WHEN 'view' THEN 'connected' WHEN 'error' THEN 'hold'
      ELSE 'disconnected' END AS state,
    source IN ('signup', 'view', 'error') AS active,
    CASE user_id % 4 WHEN 0 THEN '+1204' WHEN 1 THEN '+49' WHEN 2 THEN '+353' ELSE '+1555' END
      || (1000000 + event_id) AS phone,
    CASE user_id % 4 WHEN 0 THEN 'CA' WHEN 1 THEN 'DE' WHEN 2 THEN 'IE' ELSE 'US' END AS phone_country,
    CASE WHEN event_id % 2 = 0 THEN CASE WHEN event_id % 6 = 0 THEN 'desk' ELSE '+44' || (2000000 + user_id) END END
      AS extension,
    CASE WHEN event_id % 6 = 0 THEN 'k2,k3' ELSE '' END AS third,
    source <> 'purchase' AS merging FROM e1)"""


def _stage(stage: str) -> str:
    when = f"FILTER (merging AND status = '{stage}')"
    return f"""{iso_micros(f'min(ts) {when}')} AS {stage}_at, arg_min(props, ord) {when} AS {stage}_attributes,
    arg_min('q' || (user_id % 10), ord) {when} AS {stage}_queue, arg_min(third, ord) {when} AS {stage}_third_party"""


CONTACT_FOLD = EVENTS + f""",
cf AS (SELECT contact AS "contactId",
    arg_min(contact_type, ord) FILTER (merging AND contact_type IS NOT NULL) AS type,
    CAST(bool_or(inbound) FILTER (merging) AS INTEGER) AS inbound,
    arg_min(initial_connection, ord) FILTER (merging AND initial_connection IS NOT NULL) AS "initialConnectionId",
    {iso_micros('min(ts) FILTER (merging)')} AS "initialTimestamp",
    {', '.join(_stage(s) for s in ('connecting', 'connected', 'ended', 'error'))},
    min(ord) FILTER (merging AND status = 'ended') AS ended_ord, max(ord) FILTER (source = 'purchase') AS gone_ord,
    max(ts) - min(ts) FILTER (merging) > INTERVAL 1 DAY AS aged
  FROM ev GROUP BY contact HAVING bool_or(merging)),
cc AS (SELECT * EXCLUDE (ended_ord, gone_ord, aged),
    CASE WHEN error_at IS NOT NULL THEN 'error' WHEN gone_ord > ended_ord THEN 'destroyed' WHEN aged THEN 'abandoned'
    END AS completion FROM cf),
contacts_out AS (SELECT *, CASE WHEN completion IS NULL THEN 'pending' ELSE 'complete' END AS record_status FROM cc)"""


def _first(state: str, name: str) -> str:
    return f"""{iso_micros(f"min(ts) FILTER (state = '{state}')")} AS "{name}Timestamp" """


CONNECTION_FOLD = EVENTS + f""",
connections_out AS (SELECT contact AS "contactId", conn AS "connId",
    {', '.join(_first(s, s) for s in ('connecting', 'connected', 'disconnected'))},
    arg_max(conn_type, ord) AS type, CAST(arg_max(active, ord) AS INTEGER) AS active,
    {iso_micros('max(ts)')} AS "lastUpdate", arg_max(state, ord) AS status,
    arg_max(CASE WHEN conn = 'k0' AND extension <> 'desk' THEN extension ELSE phone END, ord) AS "phoneNumber",
    arg_max(extension, ord) FILTER (conn = 'k0') AS extension,
    CAST(arg_max(event_id % 3 <> 0, ord) FILTER (conn = 'k0') AS INTEGER) AS "softPhoneEnabled",
    arg_max(CASE WHEN conn = 'k0' THEN 'GB' ELSE phone_country END, ord) FILTER (extension IS NULL OR extension <> 'desk')
      AS "endpointCountryISO",
    count(*) AS entries
  FROM ev WHERE merging GROUP BY contact, conn)"""

LEG_KEYS = '"contactId", "connId"'
LEG_TIMES = '"connectingTimestamp", "connectedTimestamp", "disconnectedTimestamp"'
LAST_VALUES = 'type, active, "lastUpdate", status, "phoneNumber", extension, "softPhoneEnabled"'
STAGE_COLUMNS = ", ".join(f"{s}_{p}" for s in ("connecting", "connected", "ended", "error")
                          for p in ("at", "attributes", "queue", "third_party"))

_DECIDED = """SELECT contact, count(*) FILTER (merging) AS entries,
    coalesce(bool_or(status = 'error') FILTER (merging), false)
      OR coalesce(max(ord) FILTER (source = 'purchase') > min(ord) FILTER (merging AND status = 'ended'), false)
      OR max(ts) - min(ts) FILTER (merging) > INTERVAL 1 DAY AS done"""

# Two arrivals: a contact that the first completes starts anew in the second.
STORES = EVENTS + f""",
span AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM ev),
cut AS (SELECT ev.*, (epoch_us(ts) - lo) // ((hi - lo) // 2 + 1) AS arrival FROM ev, span),
one AS ({_DECIDED} FROM cut WHERE arrival = 0 GROUP BY contact HAVING bool_or(merging)),
two AS ({_DECIDED} FROM cut LEFT JOIN (SELECT contact, done AS gone FROM one) USING (contact)
  WHERE arrival = 1 OR gone IS DISTINCT FROM true GROUP BY contact HAVING bool_or(merging)),
held AS (
  SELECT 1 AS moment, CASE WHEN done THEN 'complete' ELSE 'pending' END AS store, contact, entries FROM one
  UNION ALL SELECT 2, 'complete', contact, entries FROM one WHERE done
  UNION ALL SELECT 2, CASE WHEN done THEN 'complete' ELSE 'pending' END, contact, entries FROM two)"""

HISTORY = EVENTS + f"""
SELECT contact AS "contactId", conn AS "connId", event_id AS sequence, {iso_micros('ts')} AS timestamp,
  state AS status, CAST(active AS INTEGER) AS active FROM ev WHERE merging"""

# Wire lines. -----------------------------------------------------------------------------

WIRE = CONTACTS + """,
wire AS (
  SELECT contact_id AS "ContactId", channel AS "Channel", initiated AS "InitiationTimestamp",
    CASE WHEN o_orderkey % 3 = 0 THEN 'a}{b"' ELSE 'plain' END AS "Attributes" FROM ct WHERE o_orderkey % 50 <> 7
  UNION ALL
  SELECT contact_id || 'x', channel, NULL, NULL FROM ct WHERE o_orderkey % 50 <> 7)"""

SUBMISSIONS = LEGS + """,
sent AS (SELECT CASE WHEN l_orderkey % 10 = 3 THEN '' ELSE contact_id END AS cid, inbound_text
    FROM l3 WHERE l_orderkey % 10 >= 3),
submitted AS (SELECT cid AS "contactId", inbound_text AS inbound, 'voice' AS type FROM sent
    UNION ALL SELECT cid || '/2', inbound_text, NULL FROM sent)"""


def _r1(columns: str) -> str:
    return f"WITH {CONTACTS},{R1_METRICS} SELECT {columns} FROM r1"


def _r2(columns: str) -> str:
    return f"WITH {CONTACTS},{LEGS},{VOICE} SELECT {columns} FROM r2"


def _ct(columns: str) -> str:
    return f"WITH {CONTACTS} SELECT {columns} FROM cs"


def _of(ctes: str, select: str) -> str:
    return f"WITH {ctes} {select}"


def _merged(columns: str) -> str:
    return f"WITH {LEGS} SELECT contact_id, conn_id, {columns} FROM merged"


IDENTITY = """account_id AS awsaccountid, instance AS instancearn, channel, queue AS queue_name,
  system_address AS system_endpoint, contact_id AS contactid, initial_contact_id AS "initialContactId",
  customer_address AS customer_endpoint"""
COURSE = """agent AS "AgentARN", transfer_endpoint AS "TransferEndpoint", method AS "Call_Initiation_Method",
  initiated AS "CTR_Initiation_Timestamp", agent_connected AS "Connected_To_Agent_Timestamp",
  disconnected AS "Disconnect_Timestamp", system_connected AS "Connected_To_System_Timestamp",
  transferred AS "Transfer_Completed_Timestamp" """
LEG = """leg_id AS connection_id, initial_connection AS "initialConnectionId", leg_type AS type, extension,
  softphone AS "softphoneEnabled", inbound, connecting AS "connectingTimestamp", connected AS "connectedTimestamp",
  dropped AS "disconnectedTimestamp", country AS "endpointCountryISO" """

SERVICE, DESK, THIRD, CUSTOMER = (
    "Connect_Service_Seconds", "AgentDeskPhone_Telco_inSeconds", "Thirdparty_Telco_inSeconds",
    "CustomerCallLength_Telco_inSeconds")
SOURCES = {SERVICE: ("service", 10), DESK: ("desk", 60), THIRD: ("third", 60), CUSTOMER: ("customer", 60)}


def metric(name: str) -> str:
    rounded = name.endswith("_Rounded")
    source, floor = SOURCES[name.removesuffix("_Rounded")]
    return f'{as_int(least(source, floor) if rounded else source)} AS "{name}"'


R1_NAMES = [n + end for end in ("", "_Rounded") for n in (SERVICE, THIRD, CUSTOMER)]
R2_NAMES = [n + end for end in ("", "_Rounded") for n in (SERVICE, DESK, THIRD, CUSTOMER)]

CHAT_DOCS = _of(DOCUMENTS, "SELECT * FROM docs")
DECODED = _ct("""contact_id AS "ContactId", 'transcripts/2020+01/' || contact_id || ':part café.json' AS key""")


def oracle_sql() -> dict[str, str]:
    queries = {
        "RPT-1": _r1(", ".join([IDENTITY, COURSE, *map(metric, R1_NAMES)])),
        "RPT-2": _r2(", ".join([IDENTITY, LEG, COURSE, *map(metric, R2_NAMES)])),
        "RPT-3": _of(f"{CONTACTS},{CHATS}", "SELECT * FROM r3"),
        "RPT-4": CHAT_DOCS,
        "RPT-5": _of(f"{CONTACT_FOLD},{CONNECTION_FOLD.removeprefix(EVENTS + ',')}", """
            SELECT any_value(COLUMNS(c.*)), string_agg(concat_ws('|', "connId", """ + ", ".join(
                f"coalesce(CAST(k.{name} AS VARCHAR), '-')" for name in (
                    '"connectingTimestamp"', '"connectedTimestamp"', '"disconnectedTimestamp"', "type", "active",
                    '"lastUpdate"', "status", '"phoneNumber"', "extension", '"softPhoneEnabled"',
                    '"endpointCountryISO"', "entries")) + """), ';' ORDER BY "connId") AS connections
            FROM (SELECT * RENAME (type AS contact_type) FROM contacts_out) c
            JOIN connections_out k USING ("contactId") GROUP BY c."contactId" """),
        "SRC-1": _ct("""account_id AS account, '2017-03-10' AS format_version, agent,
            CAST(o_orderkey % 30 AS INTEGER) AS work_seconds, agent_connected, CAST(o_custkey % 4 AS INTEGER) AS holds,
            'profile-' || (o_custkey % 5) AS profile, 'basic' AS profile_name, 'user' || (o_custkey % 50) AS username,
            1 AS attempts, '{"tier":' || (o_custkey % 5) || '}' AS attributes, channel, system_connected, contact_id,
            customer_address, disconnected, initial_contact_id, method, initiated, instance, last_update,
            CAST(NULL AS VARCHAR) AS next_contact_id, 'queue-' || left(o_orderpriority, 1) AS queue_arn,
            CAST(o_custkey % 7 AS INTEGER) AS queue_seconds, queue, CAST(NULL AS VARCHAR) AS recordings, system_address,
            transferred, transfer_endpoint AS transferred_to, 'AUDIO' AS media"""),
        "SRC-2": _of(LEGS + CONNECTION_ROWS, "SELECT * FROM connection_rows"),
        "SRC-3": f"""SELECT 'account-0' AS "AWSAccountId", 'agent-' || user_id AS "AgentARN", 'e' || event_id AS "EventId",
            {iso('epoch_us(ts) // 1000 * 1000')} AS "EventTimestamp", event_type AS "EventType", 'instance-1' AS "InstanceARN",
            '2017-10-01' AS "Version", CASE WHEN event_id % 3 = 0 THEN 'Available' ELSE 'Busy' END AS status,
            {iso('epoch_us(ts) // 1000 * 1000')} AS status_since, '{{"Level1":"g' || (user_id % 3) || '"}}' AS groups,
            'user' || user_id AS username, 'profile-' || (event_id % 4) AS profile,
            'VOICE:' || (event_id % 2) || ':1,CHAT:' || (event_id % 3) || ':2' AS slots,
            'q' || (event_id % 5) AS inbound_queues, 'VOICE,CHAT' AS channels,
            '{{"ContactId":"c' || event_id || '"}}' AS contact_json,
            CASE WHEN event_id % 4 <> 0 THEN CASE WHEN event_id % 3 = 2 THEN 'Available' ELSE 'Busy' END END AS previous_status,
            CASE WHEN event_id % 4 <> 0 THEN 'g' || (user_id % 3) || ',all' END AS previous_groups,
            CASE WHEN event_id % 4 <> 0 THEN CASE WHEN event_id % 2 = 0 THEN 'CONNECTED' ELSE 'MISSED' END END AS previous_state,
            CASE WHEN event_id % 4 <> 0 THEN 'default' END AS previous_queue FROM events""",
        "SRC-4": CHAT_DOCS,
        "SRC-5": _of(DOCUMENTS, """SELECT contact_id AS "ContactId", 'instance-1' AS "InstanceId",
            CAST(len(lines) AS INTEGER) AS items,
            coalesce((SELECT string_agg(type, ',' ORDER BY i) FROM items f WHERE f.conv_id = d1.conv_id AND f.turn = d1.turn), '') AS types,
            coalesce((SELECT string_agg(speaker, ',' ORDER BY i) FROM items f WHERE f.conv_id = d1.conv_id AND f.turn = d1.turn), '') AS roles
            FROM d1"""),
        "SRC-6": CHAT_DOCS,
        "SRC-6-notified": CHAT_DOCS,
        "SRC-7": f"""SELECT 'e' || event_id || twin AS "EventId", {iso('epoch_us(ts) // 1000 * 1000')} AS "EventTimestamp",
            event_type AS "EventType", 'agent-' || user_id AS "AgentARN" FROM events, (VALUES (''), ('x')) t(twin)""",
        "SRC-8": _of(LEGS, """SELECT contact_id, conn_id, country AS "endpointCountryISO",
            CAST(softphone AS INTEGER) AS softphone FROM legs"""),
        "SNK-1": _of(CONTACTS, """SELECT contact_id || twin AS "ContactId", channel AS "Channel",
            initiated AS "InitiationTimestamp", disconnected AS "DisconnectTimestamp"
            FROM ct, (VALUES (''), ('x')) t(twin)"""),
        "SNK-2": CHAT_DOCS,
        "SNK-2-merge": CHAT_DOCS,
        "SNK-3": _of(CONTACTS, """SELECT value, count(*) AS lines FROM (
            SELECT left('{"ContactId":"' || contact_id || '","Channel":"' || channel || '"', 30) AS value
            FROM ct WHERE o_orderkey % 50 = 7) GROUP BY value"""),
        "SNK-4": _of(f"{CONTACTS},{R1_METRICS}", f"""SELECT channel, method, count(*) AS contacts,
            CAST(sum({least('service', 10)}) AS BIGINT) AS service_seconds FROM r1 GROUP BY channel, method"""),
        "ING-1": _of(WIRE, "SELECT * FROM wire"),
        "ING-2": _of(WIRE, """SELECT 'Ok' AS result, count(*) AS records FROM wire UNION ALL
            SELECT 'ProcessingFailed', count(*) FROM ct WHERE o_orderkey % 50 = 7"""),
        "ING-3": _of(SUBMISSIONS, "SELECT * FROM submitted"),
        "ING-3-stream": _of(SUBMISSIONS, """SELECT * FROM submitted WHERE "contactId" <> '' """),
        "ING-5-stream": _of(SUBMISSIONS, """SELECT 'record' AS sink, count(*) AS rows FROM submitted WHERE "contactId" <> ''
            UNION ALL SELECT 'bad object', count(*) FROM submitted WHERE "contactId" = ''
            UNION ALL SELECT 'bad envelope', count(*) FROM l3 WHERE l_orderkey % 10 < 2"""),
        "ING-4": DECODED,
        "ING-5": """SELECT l_orderkey AS key, CAST(l_orderkey % 10 >= 2 AS INTEGER) AS valid,
            CAST(l_orderkey % 10 >= 3 AS INTEGER) AS has_data FROM lineitem""",
        "ING-6": _of(SUBMISSIONS, """SELECT "contactId" FROM submitted WHERE "contactId" <> '' """),
        "PRJ-1": _ct("""contact_id AS "ContactId", queue, system_address, 'profile-' || (o_custkey % 5) AS profile"""),
        "PRJ-2": _ct("""contact_id AS "ContactId", account_id AS account, method AS "Call_Initiation_Method",
            agent_connected AS "Connected_To_Agent_Timestamp" """),
        "PRJ-3": _ct(f"""* EXCLUDE (o_orderkey, o_custkey, o_orderpriority, last_update)
            REPLACE ({as_int('init_disc')} AS init_disc, {as_int('sys_disc')} AS sys_disc, {as_int('xfer_disc')} AS xfer_disc)"""),
        "PRJ-4": """SELECT 'c' || l_orderkey AS "contactId", count(*) AS records,
            CAST(sum(CASE WHEN l_discount = 0 AND l_tax = 0 THEN 0 ELSE 1 + l_suppkey % 2 END) AS BIGINT) AS snapshots
            FROM lineitem GROUP BY l_orderkey HAVING snapshots > 0""",
        "PRJ-5": _merged("extension"),
        "PRJ-6": _r1(", ".join(["contact_id", *map(metric, R1_NAMES)])),
        "FLT-1": _ct("contact_id, channel") + " WHERE channel = 'CHAT'",
        "FLT-2": _ct("""contact_id, CAST(method = 'CALLBACK' AS INTEGER) AS is_callback,
            CAST(method <> 'CALLBACK' AS INTEGER) AS not_callback, CAST(xfer_disc < 60 AS INTEGER) AS short"""),
        "FLT-3": _ct("""contact_id, CAST(method IS NULL AS INTEGER) AS no_method,
            CAST(transferred IS NOT NULL AS INTEGER) AS was_transferred"""),
        "FLT-4": _r2("""contact_id, leg_id, CASE WHEN leg_id IS NULL THEN
            CASE WHEN initial_contact_id IS NULL THEN 1 END ELSE CAST(mine AS INTEGER) END AS customer_leg"""),
        "FLT-5": _ct("contact_id, CASE WHEN method IS NOT NULL THEN 2 - CAST(method = 'CALLBACK' AS INTEGER) END AS way"),
        "FLT-6": _ct("contact_id, CASE coalesce(xfer_disc, 60) < 60 WHEN true THEN 'short' ELSE 'other' END AS kind"),
        "FLT-7": _of(DOCUMENTS, 'SELECT "contactId" AS "ContactId", customer_msg AS found FROM docs'),
        "JON-1": _r2("contact_id, leg_id"),
        "JON-2": _of(f"{CONTACTS},{CHATS}", 'SELECT "ContactId", channel, "ChatUsageTotalMsg" FROM r3'),
        "JON-3": _of(LEGS, "SELECT contact_id, conn_id, history_start FROM legs"),
        "JON-4": _merged("""CASE type WHEN 'agent' THEN extension ELSE number END AS number,
            CASE CASE WHEN type = 'agent' THEN left(extension, 3) WHEN left(number, 5) = '+1204' THEN '+1204' ELSE left(number, 3) END
              WHEN '+44' THEN 'GB' WHEN '+1204' THEN 'CA' WHEN '+49' THEN 'DE' WHEN '+15' THEN 'US' END AS country"""),
        "JON-5": _merged("CASE type WHEN 'agent' THEN extension ELSE number END AS number"),
        "AGG-1": _of(LEGS, "SELECT DISTINCT contact_id, conn_id FROM legs"),
        "AGG-2": _merged("""connecting AS "connectingTimestamp", connected AS "connectedTimestamp",
            dropped AS "disconnectedTimestamp" """),
        "AGG-3": _merged("""type, endpoint_type, number AS endpoint_number, initial_connection AS "initialConnectionId",
            country AS "endpointCountryISO" """),
        "AGG-4": _merged("CAST(softphone AS INTEGER) AS softphone"),
        "AGG-5": _merged("CAST(inbound AS INTEGER) AS inbound"),
        "AGG-6": _merged("first_seen AS initialconnecthistorytimestamp"),
        "AGG-7": _of(DOCUMENTS, "SELECT * EXCLUDE (total_msg) FROM docs"),
        "AGG-8": _of(DOCUMENTS, 'SELECT "contactId", total_msg FROM docs'),
        "AGG-9": _of(CONTACT_FOLD, "SELECT record_status, count(*) AS records FROM contacts_out GROUP BY record_status"),
        "SRT-1": _ct('contact_id AS contactid, initiated AS "CTR_Initiation_Timestamp"') + " ORDER BY initiated DESC",
        "SRT-2": _of(LEGS, """SELECT contact_id, count(*) AS legs, min(first_seen) AS first_seen
            FROM (SELECT * FROM merged ORDER BY first_seen) GROUP BY contact_id"""),
        "STR-1": _of(CONTACT_FOLD, "SELECT * EXCLUDE (completion) FROM cc"),
        "STR-2": _of(EVENTS, "SELECT kind AS event_type, count(*) AS events FROM ev GROUP BY kind"),
        "STR-3": _of(EVENTS, """SELECT contact AS "contactId", count(*) FILTER (merging) AS merged,
            max(CAST(source = 'purchase' AS INTEGER)) AS destroyed FROM ev GROUP BY contact"""),
        "STR-4": _of(CONTACT_FOLD, 'SELECT "contactId", type, "initialConnectionId", "initialTimestamp" FROM cc'),
        "STR-5": _of(CONTACT_FOLD, 'SELECT "contactId", inbound FROM cc'),
        "STR-6": _of(CONNECTION_FOLD, f"SELECT {LEG_KEYS}, entries FROM connections_out"),
        "STR-7": "WITH " + HISTORY,
        "STR-7-stream": "WITH " + HISTORY,
        "STR-8": _of(CONNECTION_FOLD, f"SELECT {LEG_KEYS}, {LEG_TIMES} FROM connections_out"),
        "STR-9": _of(CONNECTION_FOLD, f"SELECT {LEG_KEYS}, {LAST_VALUES} FROM connections_out"),
        "STR-10": _of(CONTACT_FOLD, f'SELECT "contactId", {STAGE_COLUMNS} FROM cc'),
        "STR-11": _of(CONTACT_FOLD, 'SELECT "contactId", completion, record_status FROM contacts_out'),
        "STR-12": _of(EVENTS, """SELECT contact AS "contactId", 1 AS abandoned FROM ev WHERE merging GROUP BY contact
            HAVING NOT bool_or(status IN ('ended', 'error'))"""),
        "STR-13": _of(STORES, """SELECT moment, store, contact AS "contactId", count(*) AS records, CAST(sum(entries) AS BIGINT) AS entries
            FROM held GROUP BY ALL"""),
        "STR-13-upsert": _of(EVENTS, """SELECT contact AS "contactId", event_id, kind AS event_type, status FROM ev
            QUALIFY row_number() OVER (PARTITION BY contact ORDER BY ord DESC) = 1"""),
        "STR-14": _of(EVENTS, "SELECT count(DISTINCT contact) AS contacts, count(*) AS entries FROM ev WHERE merging"),
        "STR-15": _of(EVENTS, 'SELECT contact AS "contactId", count(*) AS entries FROM ev WHERE merging GROUP BY contact'),
        "STR-16": "WITH " + HISTORY,
        "STR-17": _of(EVENTS, 'SELECT contact AS "contactId", count(*) AS submitted FROM ev GROUP BY contact'),
        "STR-18": _of(CONNECTION_FOLD, "SELECT * FROM connections_out"),
        "FN-1": _ct('contact_id AS "ContactId", epoch_us(CAST(disconnected AS timestamptz)) AS micros'),
        "FN-2": _ct('contact_id AS "ContactId", epoch_us(CAST(disconnected AS timestamptz)) / 1e6 AS unixtime'),
        "FN-3": _ct(f'contact_id AS "ContactId", {seconds("disconnected")} AS seconds'),
        "FN-4": _ct("""contact_id AS "ContactId", CAST(CAST(epoch_us(CAST(disconnected AS timestamptz)) / 1e6 AS DECIMAL(20, 0))
            AS BIGINT) AS seconds"""),
        "FN-5": _ct(f'contact_id AS "ContactId", {as_int("xfer_disc")} AS seconds'),
        "FN-6": _of(LEGS, """SELECT contact_id AS "contactId", inbound_text AS inbound,
            CASE inbound_text WHEN 'true' THEN 1 WHEN 'false' THEN 0 END AS is_inbound FROM l3"""),
        "FN-7": _of(LEGS, """SELECT contact_id AS "contactId", conn_id, CASE WHEN older = 1 THEN connecting_full
              ELSE concat_ws(',', CASE WHEN l_linenumber <> 5 THEN connecting END, connected, dropped,
                CASE WHEN lost THEN '-' END) END AS times
            FROM (SELECT *, history_start AS connecting_full FROM legs)"""),
        "FN-8": _of(LEGS, """SELECT contact_id AS "contactId", conn_id, CASE WHEN lost THEN connecting ELSE history_start END AS least,
            history_start AS strict FROM legs"""),
        "FN-9": _of(LEGS, """
            SELECT contact_id AS "contactId", conn_id, connecting AS timestamp, 'connecting' AS status FROM l3
              WHERE has_leg AND l_linenumber <> 5
            UNION ALL SELECT contact_id, conn_id, connected, 'connected' FROM l3 WHERE has_leg AND connected IS NOT NULL
            UNION ALL SELECT contact_id, conn_id, dropped, 'disconnected' FROM l3 WHERE has_leg AND dropped IS NOT NULL
            UNION ALL SELECT contact_id, conn_id, NULL, 'lost' FROM l3 WHERE has_leg AND lost
            UNION ALL SELECT contact_id, conn_id, connecting, 'connecting' FROM l3 WHERE has_leg AND l_suppkey % 2 = 1"""),
        "FN-10": _ct(f"contact_id, {as_int(least('xfer_disc', 60))} AS charged"),
        "FN-11": _of(CONTACTS, """SELECT contact_id AS "ContactId", array_to_string(list_transform(
            string_split(queue || ' after_call WORK ' || channel, ' '),
            lambda w: upper(w[1]) || lower(w[2:])), ' ') AS phrase FROM ct"""),
        "FN-12": _ct("""contact_id AS "ContactId", epoch_us(CAST(initiated AS timestamptz)) // 1000 AS millis,
            CAST(epoch_us(CAST(last_update AS timestamptz)) - epoch_us(CAST(initiated AS timestamptz)) > 120000000
              AS INTEGER) AS older"""),
        "FN-13": """SELECT doc_id, md5(to_base64(encode(text))) AS coded, CAST(length(to_base64(encode(text))) AS INTEGER)
            AS size, 1 AS restored FROM documents""",
        "FN-14": _ct("contact_id, queue, CAST(o_custkey % 4 AS INTEGER) AS holds"),
        "FN-15": _ct("""contact_id AS "ContactId", customer_address[2:5] AS area, '00' || customer_address[2:] AS dialled,
            CAST(position('T' IN initiated) AS INTEGER) AS at, channel || '/' || contact_id AS path"""),
        "FN-16": "SELECT doc_id, md5(text || '+') AS decoded FROM documents",
        "FN-17": _of(LEGS, """SELECT contact_id AS "contactId",
            CASE WHEN NOT has_leg THEN '' WHEN l_suppkey % 2 = 1 THEN conn_id || ',' || conn_id ELSE conn_id END AS ids,
            CAST(CASE WHEN has_leg AND l_linenumber = 1 THEN 1 ELSE 0 END AS BIGINT) AS own_at
            FROM l3 WHERE has_leg OR l_suppkey % 2 = 0"""),
        "UDF-1": _of(WIRE, """SELECT "ContactId", CASE "Channel" WHEN 'VOICE' THEN 'PHONE' ELSE "Channel" END AS "Channel" FROM wire"""),
        "UDF-2": CHAT_DOCS,
    }
    for n, name in enumerate(R1_NAMES, 1):
        queries[f"MET-{n}"] = _r1(f"contact_id, {metric(name)}")
    for n, name in enumerate(R2_NAMES, 7):
        queries[f"MET-{n}"] = _r2(f"contact_id, leg_id, {metric(name)}")
    return queries
