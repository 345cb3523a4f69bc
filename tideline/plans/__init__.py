"""The models of both sources, the layered job that builds them, and the registry job."""
