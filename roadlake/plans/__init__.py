"""Planning of incremental work: windows, units, requests."""
