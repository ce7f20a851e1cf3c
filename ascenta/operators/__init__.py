"""DataFrame operators of the derivation, from road network to published climbs."""
