"""Declared schemas of the landing tables (fixed field names and types)."""

from __future__ import annotations

from pyspark.sql import types as T

CONTACT = """
AWSAccountId string, AWSContactTraceRecordFormatVersion string,
Agent struct<ARN:string, AfterContactWorkDuration:int, AfterContactWorkEndTimestamp:string,
  AfterContactWorkStartTimestamp:string, AgentInteractionDuration:int, ConnectedToAgentTimestamp:string,
  CustomerHoldDuration:int, HierarchyGroups:string, LongestHoldDuration:int, NumberOfHolds:int,
  RoutingProfile:struct<ARN:string, Name:string>, Username:string>,
AgentConnectionAttempts int, Attributes string, Channel string, ConnectedToSystemTimestamp string,
ContactId string, CustomerEndpoint struct<Address:string, Type:string>, DisconnectTimestamp string,
InitialContactId string, InitiationMethod string, InitiationTimestamp string, InstanceARN string,
LastUpdateTimestamp string, MediaStreams array<struct<Type:string>>, NextContactId string,
PreviousContactId string,
Queue struct<ARN:string, DequeueTimestamp:string, Duration:int, EnqueueTimestamp:string, Name:string>,
Recording string, Recordings string, SystemEndpoint struct<Address:string, Type:string>,
TransferCompletedTimestamp string, TransferredToEndpoint string
"""

_QUEUE_REF = "struct<name:string, queueARN:string, queueId:string>"

_STAGE = f"struct<attributes:string, queue:{_QUEUE_REF}, thirdPartyConnections:array<string>, timestamp:string, type:string>"

CONNECTION = f"""
contactId string, inbound string, initialConnectionId string, initialTimestamp string, type string,
connections array<struct<id:string, connectingTimestamp:string, connectedTimestamp:string,
  disconnectedTimestamp:string,
  agentStatus:struct<agentPreferences:string, agentStates:array<string>, dialableCountries:array<string>,
    softPhoneEnabled:boolean, extension:string, name:string, permissions:array<string>,
    routingProfile:struct<channelConcurrencyMap:struct<CHAT:int, VOICE:int>, defaultOutboundQueue:{_QUEUE_REF},
      name:string, queues:array<{_QUEUE_REF}>, routingProfileARN:string, routingProfileId:string>>,
  active:string,
  endpoint:struct<agentLogin:string, endpointARN:string, endpointId:string, name:string, phoneNumber:string,
    queue:string, type:string>,
  endpointCountryISO:string, history:array<struct<active:string, status:string, timestamp:string>>,
  lastUpdate:string, status:string, type:string>>,
stageConnecting {_STAGE}, stageConnected {_STAGE}, stageEnded {_STAGE}, stageError {_STAGE}
"""


def _snapshot(groups: str, contacts: str) -> str:
    return f"""struct<AgentStatus:struct<ARN:string, Name:string, StartTimestamp:string>,
  Configuration:struct<AgentHierarchyGroups:{groups}, FirstName:string, LastName:string,
    RoutingProfile:struct<ARN:string, Concurrency:array<struct<AvailableSlots:int, Channel:string, MaximumSlots:int>>,
      DefaultOutboundQueue:struct<ARN:string, Channels:array<string>, Name:string>,
      InboundQueues:array<struct<ARN:string, Channels:array<string>, Name:string>>, Name:string>,
    Username:string>,
  Contacts:{contacts}>"""


# The two snapshots are declared differently on purpose: groups and contacts
# have other types in the earlier one.
AGENT_EVENT = f"""
AWSAccountId string, AgentARN string, CurrentAgentSnapshot {_snapshot("string", "array<string>")},
EventId string, EventTimestamp string, EventType string, InstanceARN string,
PreviousAgentSnapshot {_snapshot("array<string>", '''array<struct<Channel:string, ConnectedToAgentTimestamp:string,
    ContactId:string, InitialContactId:string, InitiationMethod:string, Queue:struct<ARN:string, Name:string>,
    QueueTimestamp:string, State:string, StateStartTimestamp:string>>''')},
Version string
"""

CHAT_USAGE = "instanceId string, contactId string, system_msg int, customer_msg int, agent_msg int, total_msg int"

TRANSCRIPT = "ContactId string, InstanceId string, Transcript array<struct<Type:string, ParticipantRole:string>>"

CALL_EVENT = """
contactId string, event_id bigint, event_type string, ts timestamp, status string, contact_type string,
inbound boolean, initialConnectionId string, connId string, conn_type string, conn_state string,
active boolean, phone_number string, extension string, soft_phone_enabled boolean, attributes string,
queue string, third_party array<string>
"""

# Fields whose spelling varies between writers.
VARIANT_SPELLINGS = ("endpointCountryISO", "softPhoneEnabled", "phoneNumber")


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def field_names(kind: T.DataType) -> set[str]:
    """Names of all fields, nested ones too."""
    if isinstance(kind, T.ArrayType):
        return field_names(kind.elementType)
    if isinstance(kind, T.StructType):
        return set(kind.names).union(*(field_names(f.dataType) for f in kind.fields))
    return set()


def narrow(schema: T.StructType, paths: list[str]) -> T.StructType:
    """The part of ``schema`` that the dotted ``paths`` reach.

    JSON scans do not prune nested fields on their own, so a report reads with
    a schema of just what it uses.
    """
    wanted: dict[str, list[str]] = {}
    for path in paths:
        head, _, rest = path.partition(".")
        wanted.setdefault(head, []).append(rest)
    fields = []
    for field in schema.fields:
        rests = wanted.pop(field.name, None)
        if rests is None:
            continue
        kind = field.dataType
        if "" not in rests:
            inner = kind.elementType if isinstance(kind, T.ArrayType) else kind
            inner = narrow(inner, rests)
            kind = T.ArrayType(inner) if isinstance(kind, T.ArrayType) else inner
        fields.append(T.StructField(field.name, kind))
    if wanted:
        raise ValueError(f"no such field: {', '.join(sorted(wanted))}")
    return T.StructType(fields)
