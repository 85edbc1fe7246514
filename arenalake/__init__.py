"""Match-telemetry marts on PySpark: raw payloads, staging, facts, marts, exports."""
