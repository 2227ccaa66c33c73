"""DataFrame operators of the warehouse (staging, core, marts, governance)."""
