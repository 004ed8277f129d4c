"""Column functions of the wire formats; none needs Python on the executors."""
