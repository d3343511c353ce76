"""Reading, writing and laying out tables; schemas; generated transactions."""
