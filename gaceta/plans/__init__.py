"""Jobs that put scans, operators and sinks together."""
