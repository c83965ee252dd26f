"""Tables, files and synthetic rows that the reports read, and the sinks they write."""
