"""The texts findings carry, as SQL expressions over the columns they mention.

Fixed values: analysts and downstream tools read these sentences as published.
"""

from __future__ import annotations

UNFAMILIAR_COUNTRY = """if(only_at IS NULL,
    concat('Unfamiliar login location: ', country, ' not in baseline [', baseline_countries, ']'),
    concat('No geographic baseline (new or dormant account): first observed success from ', country))"""

IMPOSSIBLE_TRAVEL = """concat('Impossible travel: ', prev.country, ' -> ', country, ' in ', hours_apart,
    'h requires ~', required_kmh, ' km/h (gate: {gate} km/h)',
    coalesce(concat(' [exception: ', rationale, ']'), ''))"""

AFTER_HOURS = """concat('Login at ', login_time, ' UTC outside ', baseline_source, ' hour window [',
    window_start, ':00-', window_end, ':59]')"""

BRUTE_FORCE = """concat('Brute force: ', failure_count, ' uninterrupted failures within {minutes} min ',
    'preceding success from ', source_ip)"""

BRUTEFORCE_FAILED = """concat('Failed brute force: ', failure_count, ' failures on one account from ', source_ip,
    ' on ', login_date, ', no success from that source')"""

PASSWORD_SPRAY = """concat('Password spray: ', accounts_targeted, ' accounts, ', total_failures, ' failures from ',
    source_ip, ' on ', login_date,
    if(successes > 0, concat(' - INCLUDES ', successes, ' SUCCESS(ES)'), ''))"""

INACTIVE_ACCOUNT = """concat(if(success = 1, 'CRITICAL: Successful login on ', 'Login attempt on '),
    account_status, ' account from ', country)"""

ORPHAN_DEVICE = "'Device has no valid owner in employee directory'"
INVENTORY_MISMATCH = "'Ownership conflict between inventories'"
USER_WITHOUT_DEVICE = "'Active employee has no assigned device'"

#: Names of the risk signals, in their order.
SIGNALS = ["impossible_travel", "mfa_fatigue", "ip_reputation", "device_novelty", "login_hour_anomaly"]
