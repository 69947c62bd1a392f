"""The resources: network equipment settings and status, and monthly uplink counters."""

from __future__ import annotations

from palimpsest.spec import Field, Filter, ResourceSpec


def _fields(text: str) -> list[Field]:
    """Fields from lines "kind: name name ..."."""
    out = []
    for line in text.strip().splitlines():
        kind, names = line.strip().split(":")
        out += [Field(n, kind) for n in names.split()]
    return out


def _eq(*columns: str) -> dict[str, Filter]:
    return {c: Filter("equals", c) for c in columns}


# Fixed values below: column names, keys, paths and product types.

ORGANIZATION = ResourceSpec(
    name="organization",
    keys=("id",),
    fields=(
        Field("id", required=True),
        Field("name", required=True),
        *_fields("""
            string: url
            json: api licensing cloud management
        """),
    ),
    path="/organizations/{id}",
    filters={"name": Filter("text", "name", strip=True)},
)

NETWORK = ResourceSpec(
    name="network",
    keys=("id",),
    fields=(
        Field("id", required=True),
        Field("organization_id", required=True),
        Field("name", required=True),
        *_fields("""
            array: product_types
            string: time_zone
            array: tags
            string: enrollment_string url notes
            boolean: is_bound_to_config_template
        """),
    ),
    path="/networks/{id}",
    filters={
        "org_id": Filter("equals", "organization_id"),
        "name": Filter("text", "name"),
        "network_id": Filter("equals", "id"),
        "tags_include": Filter("include", "tags"),
        "tags_exclude": Filter("exclude", "tags"),
        "product_types_include": Filter("include", "product_types"),
        "product_types_exclude": Filter("exclude", "product_types"),
    },
    sort=("name",),
    after=("organization",),
)

DEVICE = ResourceSpec(
    name="device",
    keys=("serial",),
    fields=(
        Field("serial", required=True),
        *_fields("""
            string: name network_id
            double: lat lng
            string: address notes
            array: tags
            string: model mac lan_ip firmware floor_plan_id
            json: details beacon_id_params
            string: status
        """),
    ),
    path="/devices/{serial}",
    filters={
        "org_id": Filter("scope", "network_id"),
        **_eq("serial", "network_id", "status"),
        "name": Filter("text", "name"),
        "model": Filter("text", "model"),
        "tags_include": Filter("include", "tags"),
        "tags_exclude": Filter("exclude", "tags"),
        "product_types_include": Filter("prefix_include", "model"),
        "product_types_exclude": Filter("prefix_exclude", "model"),
    },
    after=("organization",),
)

SWITCHPORT = ResourceSpec(
    name="switchport",
    keys=("serial", "port_id"),
    fields=(
        Field("serial", required=True),
        Field("port_id", required=True),
        *_fields("""
            string: name
            array: tags
            boolean: enabled poe_enabled
            string: type
            int: vlan voice_vlan
            string: allowed_vlans
            boolean: rstp_enabled
            string: stp_guard link_negotiation access_policy_type
            array: sticky_mac_allow_list
            int: sticky_mac_allow_list_limit
        """),
    ),
    path="/devices/{serial}/switch/ports/{port_id}",
    children="ports",
    parent=("serial",),
    filters={
        # Ports name no network: they belong to an organization through their device.
        "org_id": Filter("device_scope", "serial"),
        **_eq("serial", "port_id"),
        "enabled": Filter("value", "enabled"),
        "port_type": Filter("equals", "type"),
        "vlan": Filter("value", "vlan"),
    },
    sort=("serial", "port_id"),
    after=("organization",),
)

UPLINK = ResourceSpec(
    name="uplink",
    keys=("serial", "interface"),
    fields=(
        Field("serial", required=True),
        Field("interface", required=True),
        *_fields("""
            string: network_id status ip gateway public_ip primary_dns secondary_dns ip_assigned_by
            json: signal_stat
            string: connection_type apn dns1 dns2 signal_type
            int: mtu
            string: iccid imsi msisdn mcc mnc
            json: roaming
            string: provider
        """),
    ),
    path="/devices/{serial}",
    children="uplinks",
    parent=("serial", "network_id"),
    filters={
        "org_id": Filter("scope", "network_id"),
        **_eq("network_id", "serial", "interface", "status", "ip_assigned_by"),
    },
    after=("organization",),
)

UPLINK_USAGE = ResourceSpec(
    name="uplink_usage",
    keys=("network_id", "serial", "interface", "month", "year"),
    fields=(
        Field("network_id", required=True),
        Field("serial", required=True),
        Field("interface", required=True),
        *_fields("""
            int: month year
            bigint: sent received
        """),
    ),
    path="/networks/{network_id}/appliance/uplinks/usageHistory",
    versioned=False,
    children="byUplink",
    # A landed reading names its network, its organization and the time it stands for.
    parent=("network_id", "org_id", "ts"),
    filters={
        "org_id": Filter("scope", "network_id"),
        **_eq("network_id", "serial", "interface"),
    },
    after=("organization",),
)

DHCP_SERVER_POLICY = ResourceSpec(
    name="dhcp_server_policy",
    keys=("network_id",),
    fields=(
        Field("network_id", required=True),
        *_fields("""
            string: default_policy
            array: blocked_servers allowed_servers always_allowed_servers
            json: arp_inspection
        """),
    ),
    path="/networks/{network_id}/switch/dhcpServerPolicy",
    filters=_eq("network_id"),
    after=("network",),
    product_type="switch",
)

ALERT = ResourceSpec(
    name="alert",
    keys=("id",),
    fields=(
        Field("id", required=True),
        Field("org_id", required=True),
        *_fields("""
            string: category_type network_id network_name started_at resolved_at dismissed_at device_type
        """),
        Field("alert_type", raw="type"),
        *_fields("""
            string: title description severity
            json: scope
        """),
    ),
    path="/organizations/{org_id}/assurance/alerts/{id}",
    flatten={"network_id": "network.id", "network_name": "network.name"},
    filters={
        "org_id": Filter("equals", "org_id"),
        "alert_id": Filter("equals", "id"),
        **_eq("network_id", "severity", "alert_type"),
        "active_only": Filter("unresolved", "resolved_at"),
    },
    after=("organization",),
)

L3_FIREWALL_RULE = ResourceSpec(
    name="l3_firewall_rule",
    keys=("network_id", "rule_order"),
    fields=(
        Field("network_id", required=True),
        Field("rule_order", "int", required=True),
        *_fields("""
            string: comment policy protocol dest_port dest_cidr src_port src_cidr
            boolean: syslog_enabled
        """),
    ),
    path="/networks/{network_id}/appliance/firewall/l3FirewallRules",
    children="rules",
    parent=("network_id",),
    position="rule_order",
    filters=_eq("network_id", "policy", "protocol"),
    sort=("rule_order",),
    after=("network",),
    product_type="appliance",
)

VLAN = ResourceSpec(
    name="vlan",
    keys=("network_id", "vlan_id"),
    fields=(
        Field("network_id", required=True),
        Field("vlan_id", "int", raw="id", raw_kind="string", required=True),
        Field("name", required=True),
        *_fields("""
            string: appliance_ip subnet interface_id group_policy_id template_vlan_type cidr
            int: mask
            string: dhcp_handling dhcp_lease_time
            boolean: dhcp_boot_options_enabled
            string: dhcp_boot_next_server dhcp_boot_filename dns_nameservers vpn_nat_subnet
            array: dhcp_relay_server_ips
            json: fixed_ip_assignments reserved_ip_ranges dhcp_options mandatory_dhcp ipv6
        """),
    ),
    path="/networks/{network_id}/appliance/vlans/{vlan_id}",
    filters={
        **_eq("network_id"),
        "vlan_id": Filter("value", "vlan_id"),
        "name": Filter("text", "name"),
    },
    sort=("vlan_id",),
    after=("network",),
    product_type="appliance",
)

SSID = ResourceSpec(
    name="ssid",
    keys=("network_id", "number"),
    fields=(
        Field("network_id", required=True),
        Field("number", "int", required=True),
        *_fields("""
            string: name
            boolean: enabled
            string: splash_page
            boolean: ssid_admin_accessible local_auth
            string: auth_mode
        """),
        Field("psk", sensitive=True),
        *_fields("""
            string: encryption_mode wpa_encryption_mode
            json: radius_servers radius_accounting_servers
            boolean: radius_accounting_enabled radius_enabled
            string: radius_attribute_for_group_policies radius_failover_policy radius_load_balancing_policy
            string: ip_assignment_mode admin_splash_url splash_timeout
            boolean: walled_garden_enabled
            array: walled_garden_ranges
            int: min_bitrate
            string: band_selection
            int: per_client_bandwidth_limit_up per_client_bandwidth_limit_down
            boolean: visible available_on_all_aps
            array: availability_tags
            int: per_ssid_bandwidth_limit_up per_ssid_bandwidth_limit_down
            boolean: mandatory_dhcp_enabled
        """),
    ),
    path="/networks/{network_id}/wireless/ssids/{number}",
    filters={
        **_eq("network_id"),
        "number": Filter("value", "number"),
        "enabled": Filter("value", "enabled"),
    },
    sort=("number",),
    after=("network",),
    product_type="wireless",
)

APPLIANCE_MALWARE = ResourceSpec(
    name="appliance_malware",
    keys=("network_id",),
    fields=(
        Field("network_id", required=True),
        *_fields("""
            string: mode
            json: allowed_urls allowed_files
        """),
    ),
    path="/networks/{network_id}/appliance/security/malware",
    filters=_eq("network_id"),
    after=("network",),
    product_type="appliance",
)

RESOURCES = {
    spec.name: spec
    for spec in (
        ORGANIZATION,
        ALERT,
        UPLINK,
        UPLINK_USAGE,
        DEVICE,
        SWITCHPORT,
        NETWORK,
        DHCP_SERVER_POLICY,
        L3_FIREWALL_RULE,
        VLAN,
        SSID,
        APPLIANCE_MALWARE,
    )
}
